"""W1-W9 from mergeable monthly state.

A month's state holds, for every group of W1-W7, its row count and sums, and for
both medians the count of every distinct value: one GROUPING SETS pass over the
month's kept trips. States of any months add up, so after a load only the
months that were loaded are summarised again, and the metrics of all months come
from the states: a few rows per hour, zone and passenger value and month, and
the distinct prices and distances, never from trips of earlier months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dashboard as dash
from .joins import DEFAULT_MAX_BROADCAST_ROWS
from .selection import percentiles

MONTH = "year_month"
SUMS = ["fare_amount", "trip_distance", "tip_amount"]  # all that W1-W7 average
VALUES = [col for _, col in dash.MEDIANS]
_KEYS = {k: T.LongType() if k.endswith("_hour") else T.DoubleType() if k == "passenger_count"
         else T.StringType() for keys, _ in dash.GROUP_METRICS for k in keys}
SCHEMA = T.StructType([
    T.StructField("metric_set", T.StringType()),
    *[T.StructField(k, kind) for k, kind in _KEYS.items()],
    T.StructField("value", T.DoubleType()), T.StructField("n", T.LongType()),
    *[T.StructField(f"sum_{c}", T.DoubleType()) for c in SUMS], T.StructField(MONTH, T.StringType())])


def _name(keys: list[str]) -> str:
    return "+".join(keys)


def month_state(base: DataFrame) -> DataFrame:
    """State rows of all months in ``base`` (kept trips with ``year_month``)."""
    sets = [keys for keys, _ in dash.GROUP_METRICS] + [[v] for v in VALUES]
    order = [*_KEYS, *VALUES]
    totals = {c: f"_total_{c}" for c in SUMS}
    rows = base.select(MONTH, *order, *[F.col(c).alias(t) for c, t in totals.items()])
    grouped = rows.groupingSets([[MONTH, *keys] for keys in sets], MONTH, *order).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(t).alias(f"sum_{c}") for c, t in totals.items()],
        F.grouping_id().alias("_gid"))
    ids = {sum(1 << (len(order) - 1 - i) for i, k in enumerate(order) if k not in keys): keys
           for keys in sets}
    name = value = F.lit(None)
    for gid, keys in ids.items():
        name = F.when(F.col("_gid") == gid, F.lit(_name(keys))).otherwise(name)
        if keys[0] in VALUES and len(keys) == 1:
            value = F.when(F.col("_gid") == gid, F.col(keys[0])).otherwise(value)
    return grouped.select(
        name.alias("metric_set"), *[F.col(k).cast(kind).alias(k) for k, kind in _KEYS.items()],
        value.cast("double").alias("value"), "n", *[f"sum_{c}" for c in SUMS], MONTH)


def group_stats(state: DataFrame) -> DataFrame:
    """W1-W7 of all months of ``state``, in the form that ``dashboard`` attaches."""
    rows = state.filter(F.col("metric_set").isin([_name(k) for k, _ in dash.GROUP_METRICS]))
    total = rows.groupBy("metric_set", *_KEYS).agg(
        F.sum("n").alias("n"), *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in SUMS])
    gid = F.lit(None)
    for keys, _ in dash.GROUP_METRICS:
        gid = F.when(F.col("metric_set") == _name(keys), F.lit(dash.part_id(keys))).otherwise(gid)
    metrics = [(F.col("n") if kind == "count" else F.col(f"sum_{col}") / F.col("n")).alias(name)
               for _, specs in dash.GROUP_METRICS for name, kind, col in specs]
    return total.select(*_KEYS, *metrics, gid.alias("_gid"))


def medians(state: DataFrame) -> dict[str, float]:
    """W8/W9 of all months of ``state``: exact, from the counts of values."""
    counts = state.filter(F.col("metric_set").isin(VALUES)).select(
        F.col("metric_set").alias("_k"), F.col("value").alias("_v"), F.col("n").alias("_n"))
    return percentiles(counts, 0.5)


def dashboard(base: DataFrame, state: DataFrame,
              broadcast_max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """The 48 dashboard columns of the kept trips ``base``, metrics from ``state``."""
    found = medians(state)
    out = dash.attach_groups(base, group_stats(state).checkpoint(eager=True), broadcast_max_rows)
    out = out.select("*", *[F.lit(found.get(col)).cast("double").alias(name)
                            for name, col in dash.MEDIANS])
    return dash.labels(out).select(*dash.DASHBOARD_COLUMNS)
