"""Least squares for many series at once.

The normal equations are sums over rows, so Spark adds them up per series with partial sums on each
side of the shuffle; only the small system of each series is solved in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

SQL_LIMIT = 10


def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def dot(coefficients, values) -> Column:
    """Inner product of two array columns."""
    return F.aggregate(F.zip_with(coefficients, values, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def moments(df: DataFrame, keys: list[str], design: list[str], target: str) -> DataFrame:
    """Per key: ``n`` and ``moments``, the upper triangle (by rows) of Z'Z for Z = (design, target).

    Rows with an unknown value are left out. Few columns are summed as SQL products; wide designs send one
    small matrix per run of equal keys in a batch, which are added up by the vector summarizer.
    """
    cols = [*design, target]
    known = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).na.drop(subset=cols)
    if len(design) <= SQL_LIMIT:
        products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(cols) for b in cols[i:]]
        return known.groupBy(*keys).agg(F.count("*").alias("n"), F.array(*products).alias("moments"))
    return moments_of_array(known.select(*keys, F.array(*[F.col(c) for c in design]).alias("x"), target), keys, "x", target)


def moments_of_array(df: DataFrame, keys: list[str], x: str, target: str) -> DataFrame:
    """As ``moments`` with the design row in one array column without unknown values."""
    fields = _key_fields(df, keys)
    schema = T.StructType([*fields, T.StructField("_z", T.ArrayType(T.DoubleType()))])

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            changed = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy() if keys else np.zeros(len(pdf), bool)
            changed[0] = True
            starts = np.flatnonzero(changed)
            z = np.column_stack([np.vstack(pdf[x].to_numpy()), pdf[target].to_numpy(float)])
            upper = np.triu_indices(z.shape[1])
            sums = [np.concatenate([[b.shape[0]], (b.T @ b)[upper]]) for b in np.split(z, starts[1:])]
            yield pdf.iloc[starts][keys].assign(_z=sums)

    known = df.select(*keys, x, target).where(F.col(target).isNotNull() & F.col(x).isNotNull())
    # series in one piece give one partial matrix per batch rather than one per row
    parts = (known.sortWithinPartitions(*keys) if keys else known).mapInPandas(partial_sums, schema)
    summed = parts.groupBy(*keys).agg(Summarizer.sum(array_to_vector("_z")).alias("_s"))
    arrays = summed.select(*keys, vector_to_array("_s").alias("_a"))
    return arrays.select(*keys, F.round(F.col("_a")[0]).cast("bigint").alias("n"),
                         F.slice("_a", F.lit(2), F.size("_a") - 1).alias("moments"))


def unpack(triangle) -> tuple[np.ndarray, np.ndarray, float]:
    """(X'X, X'y, y'y) from the stored triangle."""
    values = np.asarray(triangle, float)
    k = int((np.sqrt(8 * len(values) + 1) - 1) / 2)
    full = np.zeros((k, k))
    full[np.triu_indices(k)] = values
    full = full + np.triu(full, 1).T
    return full[:-1, :-1], full[:-1, -1], float(full[-1, -1])


def solve(xtx: np.ndarray, xty: np.ndarray, ridge: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, inverse of the scaled normal matrix). Columns are scaled to unit length first; a
    column that is zero or a copy of others gets the smallest coefficient."""
    size = np.sqrt(np.diag(xtx))
    scale = np.where(size > 0, size, 1.0)
    scaled = xtx / np.outer(scale, scale)
    if ridge is not None:
        scaled = scaled + np.diag(ridge / scale ** 2)
    inverse = np.linalg.pinv(scaled, rcond=1e-11, hermitian=True)
    return (inverse @ (xty / scale)) / scale, inverse / np.outer(scale, scale)


def residual_sum(xtx: np.ndarray, xty: np.ndarray, yty: float, beta: np.ndarray) -> float:
    return max(0.0, float(yty - 2 * beta @ xty + beta @ xtx @ beta))


def information(n: int, rss: float, k: int) -> tuple[float, float]:
    """(AIC, BIC) of a least-squares fit up to a constant: n·ln(RSS/n) + penalty."""
    fit = n * np.log(max(rss, 1e-300) / n)
    return fit + 2 * k, fit + k * np.log(n)


FIT_FIELDS = [
    T.StructField("n", T.LongType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("se", T.ArrayType(T.DoubleType())),
    T.StructField("rss", T.DoubleType()),
    T.StructField("sigma2", T.DoubleType()),
    T.StructField("aic", T.DoubleType()),
    T.StructField("bic", T.DoubleType()),
]


def per_series(grams: DataFrame, keys: list[str], fields: list[T.StructField],
               fit: Callable[[pd.Series], dict | None]) -> DataFrame:
    """Apply ``fit`` to each row of a table with one row per series, inside Arrow batches."""
    names = [f.name for f in fields]
    schema = T.StructType([*_key_fields(grams, keys), *fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(row, fit(row)) for _, row in pdf.iterrows()]
            done = [[*(row[k] for k in keys), *(out[c] for c in names)] for row, out in rows if out is not None]
            yield pd.DataFrame(done, columns=[*keys, *names])

    return grams.mapInPandas(run, schema)


def grouped_ols(df: DataFrame, keys: list[str], design: list[str], target: str) -> DataFrame:
    """Ordinary least squares per key; keys with fewer rows than columns are left out."""
    def fit(row):
        xtx, xty, yty = unpack(row["moments"])
        n, k = int(row["n"]), len(xty)
        if n <= k:
            return None
        beta, inverse = solve(xtx, xty)
        rss = residual_sum(xtx, xty, yty, beta)
        sigma2 = rss / (n - k)
        aic, bic = information(n, rss, k)
        return {"n": n, "coef": beta, "se": np.sqrt(np.maximum(0, np.diag(inverse) * sigma2)), "rss": rss,
                "sigma2": sigma2, "aic": aic, "bic": bic}
    return per_series(moments(df, keys, design, target), keys, FIT_FIELDS, fit)


def coefficient_rows(fits: DataFrame, keys: list[str], terms: list[str], col: str = "coef") -> DataFrame:
    """``(series, term, value)`` rows for the model table."""
    names = F.array(*[F.lit(t) for t in terms])
    pairs = F.map_from_arrays(names, F.col(col))
    return fits.select(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("series"), F.explode(pairs).alias("term", "value"))
