"""Reading the sales tables (CSV or Parquet) and setting bad input aside."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import schemas

# File name of each table inside a data folder.
FILE_NAMES = {
    "sales": "train",
    "stores": "stores",
    "oil": "oil",
    "holidays": "holidays_events",
    "transactions": "transactions",
    "future": "test",
}
TABLE_SCHEMAS = {
    "sales": schemas.SALES,
    "stores": schemas.STORES,
    "oil": schemas.OIL,
    "holidays": schemas.HOLIDAYS,
    "transactions": schemas.TRANSACTIONS,
    "future": schemas.FUTURE,
}


@dataclass
class SalesBundle:
    """The sales fact with its exogenous tables."""

    sales: DataFrame
    stores: DataFrame
    oil: DataFrame
    holidays: DataFrame
    transactions: DataFrame
    future: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        found = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in found.items() if df is not None}


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is the missing marker of the source files; Spark's is NULL."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns
    ])


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return nan_to_null(reader.format(fmt).load(path))


def read_sales_bundle(spark: SparkSession, folder: str | None = None, fmt: str = "csv",
                      paths: dict[str, str] | None = None, with_future: bool = False) -> SalesBundle:
    """All tables of a folder, or of an explicit path per table."""
    if (folder is None) == (paths is None):
        raise ValueError("give either a folder or one path per table")
    wanted = [t for t in FILE_NAMES if t != "future" or with_future or (paths and "future" in paths)]
    if paths is None:
        paths = {t: f"{folder.rstrip('/')}/{FILE_NAMES[t]}.{fmt}" for t in wanted}
    missing = [t for t in wanted if t not in paths]
    if missing:
        raise ValueError(f"no path for {missing}")
    return SalesBundle(**{t: read_table(spark, paths[t], TABLE_SCHEMAS[t], fmt) for t in wanted})


def read_with_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected raw lines) of CSV files with the schema's header.

    A line is rejected when the parser cannot fit it to the schema.
    """
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"}
    lines = spark.read.text(path).where(F.col("value") != ",".join(schema.names))
    rows = lines.select("value", F.from_csv("value", f"{types}, _raw string", options).alias("row"))
    bad = F.col("row._raw").isNotNull()
    valid = rows.where(~bad).select(*[F.col("row").getField(c).alias(c) for c in schema.names])
    return nan_to_null(valid), rows.where(bad).select(F.col("value").alias("raw_line"))


def split_valid(df: DataFrame, rule) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the rule, rows that do not or for which it is unknown)."""
    ok = F.coalesce(rule, F.lit(False))
    return df.where(ok), df.where(~ok)
