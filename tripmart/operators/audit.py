"""Audit queries: row counts (A2/Q1), NULL counts (A4), key uniqueness (Q2)
and REQUIRED columns (Q3). Each runs as one Spark job over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A2/Q1: (table_name, row_count) for every table, as one result."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that counts Parquet rows from file footers.

    It reads Parquet through the version 2 source with aggregate push-down: a
    count, total or by partition column, touches no column and no page."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_counts(spark: SparkSession, paths: dict[str, Sequence[str]],
                  base_path: str | None = None) -> DataFrame:
    """A2/Q1: (table_name, row_count) of Parquet tables, each a list of folders or
    files, from their footers alone. A table without a path has no rows."""
    other = footer_session(spark)
    parts = []
    for name, where in paths.items():
        if not where:
            parts.append(other.range(1).select(F.lit(name).alias("table_name"),
                                               F.lit(0).cast("bigint").alias("row_count")))
            continue
        reader = other.read.option("basePath", base_path) if base_path else other.read
        parts.append(reader.parquet(*where).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def footer_counts_by(spark: SparkSession, paths: Sequence[str], column: str,
                     base_path: str) -> DataFrame:
    """(column, row_count) of Parquet folders below ``base_path`` by one partition
    column, from footers alone, in one read."""
    rows = footer_session(spark).read.option("basePath", base_path).parquet(*paths)
    return rows.groupBy(F.col(column).cast("string").alias(column)).agg(
        F.count(F.lit(1)).alias("row_count"))


def _missing(df: DataFrame, c: str):
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: one row, one column per input column = number of missing values
    (NULL, and NaN for floating point), all in one pass."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in cols])


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4 as rows: (column_name, missing)."""
    cols = list(cols or df.columns)
    wide = null_counts(df, cols)
    return wide.unpivot([], cols, "column_name", "missing")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q2: key values held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def key_report(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    """Q2 for several tables: (table_name, duplicate_keys, duplicate_rows)."""
    parts = []
    for name, df in tables.items():
        v = key_violations(df, keys[name])
        parts.append(v.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint")
                           .alias("duplicate_rows"))
                     .select(F.lit(name).alias("table_name"), "duplicate_keys",
                             "duplicate_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def required_violations(tables: dict[str, DataFrame],
                        required: dict[str, Sequence[str]]) -> DataFrame:
    """Q3: (table_name, column_name, missing) for every REQUIRED column."""
    parts = []
    for name, df in tables.items():
        cols = list(required.get(name, []))
        if not cols:
            continue
        parts.append(missing_report(df, cols)
                     .select(F.lit(name).alias("table_name"), "column_name", "missing"))
    return reduce(lambda a, b: a.unionByName(b), parts)
