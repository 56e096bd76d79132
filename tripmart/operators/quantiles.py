"""Exact, interpolated percentiles without a single-task step.

``percentile()`` merges one map of value -> count per task into a single
task, so its memory grows with the number of distinct values. Here the
distinct values are counted in parallel, range-partitioned and given
running counts per range; a table of range totals (one row per partition)
turns them into global ranks. Only the (at most two) values at the wanted
ranks are brought together.

The result equals ``percentile(col, q)`` and SQL's ``PERCENTILE_CONT``:
with N non-NULL values and position p = q * (N - 1), the values at ranks
floor(p) and ceil(p) are interpolated linearly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def frequencies(df: DataFrame, col: str) -> DataFrame:
    """(_v, _n): each distinct non-missing value of ``col`` with its count.

    Counted with partial aggregation before the shuffle, so a hot value
    costs one row per task."""
    return (df.select(F.col(col).cast("double").alias("_v"))
            .filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
            .groupBy("_v").agg(F.count(F.lit(1)).alias("_n")))


def exact_percentile(df: DataFrame, col: str, q: float = 0.5, alias: str = "percentile",
                     num_partitions: int | None = None) -> DataFrame:
    """One row, one column ``alias``: the exact percentile ``q`` of ``col``.

    NULLs (and NaN) are ignored; an empty input gives NULL.
    """
    return percentile_of_counts(frequencies(df, col), q, alias, num_partitions)


def percentile_of_counts(freq: DataFrame, q: float = 0.5, alias: str = "percentile",
                         num_partitions: int | None = None) -> DataFrame:
    """The exact percentile ``q`` of values given as (_v, _n) counts, in one row
    (NULL without values)."""
    one = percentiles_of_counts(freq.withColumn("_k", F.lit(0)), q, num_partitions)
    return one.agg(F.max("percentile").alias(alias))


def percentiles_of_counts(freq: DataFrame, q: float = 0.5,
                          num_partitions: int | None = None) -> DataFrame:
    """(_k, percentile): the exact percentile ``q`` per key of (_k, _v, _n) counts.

    The values of all keys are range-partitioned together and checkpointed
    (where the ranges fall may differ between two evaluations); each range
    gets running counts, and the range totals (one row per partition and
    key) give each value its rank. The route is the same at every size.
    """
    checkpoint_dir(freq.sparkSession)
    freq = freq.filter(F.col("_v").isNotNull() & ~F.isnan("_v")).select("_k", "_v", "_n")
    ranged = (freq.repartitionByRange(num_partitions, "_k", "_v") if num_partitions
              else freq.repartitionByRange("_k", "_v"))
    bucketed = ranged.withColumn("_b", F.spark_partition_id()).checkpoint(eager=True)
    within = Window.partitionBy("_k", "_b").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = bucketed.withColumn("_cum", F.sum("_n").over(within))
    totals = bucketed.groupBy("_k", "_b").agg(F.sum("_n").alias("_total"))
    # one row per range and key: rows in the key's earlier ranges, and rows overall
    by_key = Window.partitionBy("_k").orderBy("_b")
    offsets = totals.select(
        "_k", "_b",
        F.coalesce(F.sum("_total").over(by_key.rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_total").over(by_key.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    ranks = local.join(offsets, ["_k", "_b"]).select(
        "_k", "_v", (F.col("_off") + F.col("_cum") - F.col("_n")).alias("_first"),
        (F.col("_off") + F.col("_cum") - 1).alias("_last"), "_all")
    pos = (F.col("_all") - 1).cast("double") * F.lit(float(q))
    lo, hi = F.floor(pos), F.ceil(pos)
    hit_lo = (F.col("_first") <= lo) & (lo <= F.col("_last"))
    hit_hi = (F.col("_first") <= hi) & (hi <= F.col("_last"))
    picked = ranks.filter(hit_lo | hit_hi).select(
        "_k", F.when(hit_lo, F.col("_v")).alias("_lo_v"),
        F.when(hit_hi, F.col("_v")).alias("_hi_v"),
        pos.alias("_pos"), lo.alias("_lo"), hi.alias("_hi"))
    agg = picked.groupBy("_k").agg(
        F.max("_lo_v").alias("lv"), F.max("_hi_v").alias("hv"), F.max("_pos").alias("p"),
        F.max("_lo").alias("l"), F.max("_hi").alias("h"))
    value = F.when(F.col("h") == F.col("l"), F.col("lv")).otherwise(
        (F.col("h") - F.col("p")) * F.col("lv") + (F.col("p") - F.col("l")) * F.col("hv"))
    return agg.select("_k", value.alias("percentile"))
