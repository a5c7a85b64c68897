"""Searching settings for every series at once."""

from __future__ import annotations

import random
from dataclasses import replace
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .additive import Additive, AdditiveSettings, prior_scales, prior_solve
from .linear import moments_of_array, per_series, residual_sum, unpack


def full_grid(space: dict[str, list]) -> list[dict]:
    return [dict(zip(space, values)) for values in product(*space.values())]


def draw(space: dict[str, list], n_trials: int, seed: int = 42) -> list[dict]:
    """Random settings: whole numbers and reals between the extremes of their list, or one of its values."""
    rng = random.Random(seed)

    def one(values):
        if isinstance(values[0], bool) or isinstance(values[0], str):
            return rng.choice(values)
        if isinstance(values[0], int):
            return rng.randint(min(values), max(values))
        if isinstance(values[0], float):
            return rng.uniform(min(values), max(values))
        return rng.choice(values)
    return [{k: one(v) for k, v in space.items()} for _ in range(n_trials)]


TRIAL_FIELDS = [T.StructField("trials", T.ArrayType(T.StructType([
    T.StructField("candidate", T.IntegerType()), T.StructField("rmse", T.DoubleType())])))]


def search_additive(train: DataFrame, validation: DataFrame, keys: list[str], candidates: list[dict],
                    base: AdditiveSettings = AdditiveSettings(seasonality_mode="additive")) -> DataFrame:
    """Validation rmse of every candidate and series, as ``(keys, candidate, rmse)``.

    Candidates differ in prior scales only, so the sums over rows are made once for training and once for
    validation; a candidate costs one small solve per series. A failed fit has no rmse.
    """
    fixed = {"changepoint_prior_scale", "seasonality_prior_scale", "holidays_prior_scale"}
    wrong = {k for c in candidates for k in c} - fixed
    if wrong:
        raise ValueError(f"cannot search {sorted(wrong)}")
    scales = [prior_scales(replace(base, **c)) for c in candidates]
    model = Additive(tuple(keys), base)
    spans = model._spans(train)

    def sums(rows, suffix):
        return moments_of_array(model._designed(rows, spans), keys, "_x", "y").select(
            *keys, F.col("n").alias(f"n{suffix}"), F.col("moments").alias(f"moments{suffix}"))
    both = sums(train, "").join(sums(validation, "_val"), keys)

    def trial(row):
        xtx, xty, yty = unpack(row["moments"])
        vxx, vxy, vyy = unpack(row["moments_val"])
        out = []
        for i, scale in enumerate(scales):
            try:
                beta, _ = prior_solve(xtx, xty, yty, int(row["n"]), scale, base.changepoints)
                value = float(np.sqrt(residual_sum(vxx, vxy, vyy, beta) / int(row["n_val"])))
            except np.linalg.LinAlgError:
                value = None
            out.append({"candidate": i, "rmse": value if value is not None and np.isfinite(value) else None})
        return {"trials": out}
    return per_series(both, keys, TRIAL_FIELDS, trial).select(*keys, F.inline("trials"))


def best_candidate(trials: DataFrame, keys: list[str] = ()) -> DataFrame:
    """The candidate with the lowest mean rmse (per key); one without any counts as infinite, ties go to
    the first."""
    scored = trials.groupBy(*keys, "candidate").agg(F.avg("rmse").alias("rmse"))
    rank = F.struct(F.coalesce("rmse", F.lit(float("inf"))), "candidate")
    return scored.groupBy(*keys).agg(F.min_by("candidate", rank).alias("candidate"), F.min("rmse").alias("rmse"))
