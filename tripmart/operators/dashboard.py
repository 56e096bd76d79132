"""The wide dashboard table: star join, derived columns, filter, nine
whole-partition metrics and three labels (J2, J3, D9-D16, F1, W1-W9).

Written as window functions, the global medians would move every kept row
through one task. The plan here keeps the filtered, joined base, runs one
GROUPING SETS pass over it (partial aggregation before the shuffle) that
yields the seven group metrics, checkpoints that small result, and attaches it
with size-checked broadcast hash joins on NULL-safe keys. Both medians are
selected together in a few passes that move bin counters only
(``operators.selection``). No step sends the base to a single task, and a hot
key only adds to a map-side partial count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import whole_minutes
from ..functions.labels import distance_category, fare_per_mile, has_tip, time_period
from ..session import checkpoint_dir
from .joins import DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast, null_safe_on
from .selection import percentiles, value_counts

# Column order of the joined trip rows (33 columns).
TRIP_COLUMNS = [
    "VendorID", "vendor_name",
    "tpep_pickup_datetime", "pickup_hour", "pickup_day", "pickup_month", "pickup_year",
    "pickup_weekday",
    "tpep_dropoff_datetime", "dropoff_hour", "dropoff_day", "dropoff_month", "dropoff_year",
    "dropoff_weekday",
    "passenger_count", "trip_distance", "ratecode_name",
    "pickup_Borough", "pickup_Zone", "pickup_service_zone",
    "dropoff_Borough", "dropoff_Zone", "dropoff_service_zone",
    "payment_name", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "Airport_fee",
]
DERIVED_COLUMNS = ["trip_duration_minutes", "has_tip", "fare_per_mile"]
METRIC_COLUMNS = [
    "avg_pickup_hourly_fare", "avg_pickup_hourly_distance", "pickup_trips_per_zone",
    "avg_dropoff_hourly_fare", "avg_dropoff_hourly_distance", "dropoff_trips_per_zone",
    "avg_tip_by_passengers", "median_fare", "median_distance",
]
LABEL_COLUMNS = ["pickup_time_period", "dropoff_time_period", "distance_category"]
DASHBOARD_COLUMNS = TRIP_COLUMNS + DERIVED_COLUMNS + METRIC_COLUMNS + LABEL_COLUMNS

# Group metrics: (grouping columns, [(output, aggregate, input column)]).
GROUP_METRICS = [
    (["pickup_hour"], [("avg_pickup_hourly_fare", "avg", "fare_amount"),
                       ("avg_pickup_hourly_distance", "avg", "trip_distance")]),
    (["dropoff_hour"], [("avg_dropoff_hourly_fare", "avg", "fare_amount"),
                        ("avg_dropoff_hourly_distance", "avg", "trip_distance")]),
    (["pickup_Borough", "pickup_Zone"], [("pickup_trips_per_zone", "count", None)]),
    (["dropoff_Borough", "dropoff_Zone"], [("dropoff_trips_per_zone", "count", None)]),
    (["passenger_count"], [("avg_tip_by_passengers", "avg", "tip_amount")]),
]


def _agg(kind: str, col: str | None):
    return F.count(F.lit(1)) if kind == "count" else F.avg(col)


MEDIANS = [("median_fare", "fare_amount"), ("median_distance", "trip_distance")]


def quality_filter(df: DataFrame) -> DataFrame:
    """positive distance, fare and total; 1..6 passengers (NULL fails)."""
    return df.filter(
        (F.col("trip_distance") > 0) & (F.col("fare_amount") > 0) & (F.col("total_amount") > 0)
        & (F.col("passenger_count") > 0) & (F.col("passenger_count") <= 6))


def _zone_role(location: DataFrame, prefix: str) -> DataFrame:
    """The zone dimension under one role (pickup or dropoff)."""
    return location.select(
        F.col("LocationID").alias(f"{prefix}_LocationID"),
        F.col("Borough").alias(f"{prefix}_Borough"),
        F.col("Zone").alias(f"{prefix}_Zone"),
        F.col("service_zone").alias(f"{prefix}_service_zone"))


def enrich(fact: DataFrame, tables: dict[str, DataFrame],
           broadcast_max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """J2 + D9/D11/D12/D16: the star joined into 33 trip columns + 3 derived.

    All joins are inner, so facts whose keys have no dimension row drop out.
    The calendar join is on (year_month, datetime_id), since keys restart in
    every month; it is the only shuffled join. The other dimensions are
    broadcast after a size check. ``keep``: more columns to pass through.
    """
    dt = tables["datetime_dim"].drop("pickup_date", "dropoff_date")
    small = {t: checked_broadcast(tables[t], broadcast_max_rows) for t in
             ("location_dim", "vendor_dim", "Ratecode_dim", "payment_type_dim")}
    location = small["location_dim"]
    joined = (
        fact.join(dt, on=["year_month", "datetime_id"])
        .join(small["vendor_dim"], on="VendorID")
        .join(small["Ratecode_dim"], on="RatecodeID")
        .join(_zone_role(location, "pickup"),
              F.col("PULocationID") == F.col("pickup_LocationID"))
        .join(_zone_role(location, "dropoff"),
              F.col("DOLocationID") == F.col("dropoff_LocationID"))
        .join(small["payment_type_dim"], on="payment_type"))
    return joined.select(
        *TRIP_COLUMNS,
        whole_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
        .alias("trip_duration_minutes"),
        has_tip("tip_amount").alias("has_tip"),
        fare_per_mile("fare_amount", "trip_distance").alias("fare_per_mile"), *keep)


def trip_base(tables: dict[str, DataFrame], broadcast_max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Kept trips with derived columns: the input of every metric.

    The filter touches fact columns only; Catalyst evaluates it on the fact
    scan, below all joins.
    """
    return enrich(quality_filter(tables["fact_trips"]), tables, broadcast_max_rows, keep)


def labels(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        time_period("pickup_hour").alias("pickup_time_period"),
        time_period("dropoff_hour").alias("dropoff_time_period"),
        distance_category("trip_distance").alias("distance_category"))


def medians(base: DataFrame, cols: list[str]) -> dict[str, float]:
    """The interpolated median of each of ``cols``, NULLs ignored, by
    selection: no task ever holds all values. ``base`` is read a few times."""
    return percentiles(value_counts(base, cols), 0.5)


def _key_order() -> list[str]:
    order: list[str] = []
    for keys, _ in GROUP_METRICS:
        order += [k for k in keys if k not in order]
    return order


def grouping_stats(base: DataFrame) -> DataFrame:
    """W1-W7 in one GROUPING SETS pass over the base: the seven group metrics.

    ``grouping_id()`` (``_gid``) tells sets apart, so a real NULL key (a zone
    without a name) is not confused with the padding of another set.
    """
    aggs = [_agg(kind, c).alias(name) for _, specs in GROUP_METRICS for name, kind, c in specs]
    return base.groupingSets([keys for keys, _ in GROUP_METRICS], *_key_order()).agg(
        *aggs, F.grouping_id().alias("_gid"))


def part_id(keys: list[str]) -> int:
    """``grouping_id()`` of the set that groups by ``keys``."""
    order = _key_order()
    return sum(1 << (len(order) - 1 - i) for i, k in enumerate(order) if k not in keys)


def split_stats(stats: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """One small frame per set of W1-W7."""
    return [(keys, stats.filter(F.col("_gid") == part_id(keys))
             .select(*keys, *[n for n, _, _ in specs])) for keys, specs in GROUP_METRICS]


def attach_groups(base: DataFrame, stats: DataFrame,
                  broadcast_max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """W1-W7 joined onto ``base``. Each set's row count is checked before its
    join-back is broadcast; beyond the bound that join is shuffled (AQE splits a
    skewed key)."""
    sizes = {r["_gid"]: r["count"] for r in stats.groupBy("_gid").count().collect()}  # 5 rows
    out = base
    for keys, part in split_stats(stats):
        renamed = part.select(*[F.col(k).alias(f"_key_{k}") for k in keys],
                              *[c for c in part.columns if c not in keys])
        if sizes.get(part_id(keys), 0) <= broadcast_max_rows:  # checked per set
            renamed = F.broadcast(renamed)
        out = out.join(renamed, null_safe_on(keys), "inner").drop(*[f"_key_{k}" for k in keys])
    return out


def aggregate_metrics(base: DataFrame, broadcast_max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      kept: bool = True) -> DataFrame:
    """W1-W9 without windows: small aggregates joined back onto ``base``.

    One GROUPING SETS pass gives the seven group metrics; its result (one row
    per hour, zone and passenger value) is checkpointed into the shared
    checkpoint folder, so the join-backs read it instead of re-running the
    pass. Both medians are selected from the base, as two values. If the base
    is not ``kept`` (cheap to read again), its value counts are, for that.
    """
    checkpoint_dir(base.sparkSession)
    out = attach_groups(base, grouping_stats(base).checkpoint(eager=True), broadcast_max_rows)
    counts = value_counts(base, [col for _, col in MEDIANS])
    if not kept:
        counts = counts.groupBy("_k", "_v").agg(F.sum("_n").alias("_n")).checkpoint(eager=True)
    found = percentiles(counts, 0.5)
    return out.select("*", *[F.lit(found.get(col)).cast("double").alias(name)
                             for name, col in MEDIANS])


def with_metric(base: DataFrame, name: str, broadcast_max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """One of W1-W9 attached to ``base``, which is checkpointed for its two readers."""
    checkpoint_dir(base.sparkSession)
    base = base.checkpoint(eager=True)
    for col_name, col in MEDIANS:
        if col_name == name:
            return base.select("*", F.lit(medians(base, [col]).get(col)).cast("double").alias(name))
    for keys, specs in GROUP_METRICS:
        for out, kind, col in specs:
            if out != name:
                continue
            agg = base.groupBy(*keys).agg(_agg(kind, col).alias(out)).select(
                *[F.col(k).alias(f"_key_{k}") for k in keys], out)
            agg = checked_broadcast(agg, broadcast_max_rows)
            return base.join(agg, null_safe_on(keys), "inner").drop(*[f"_key_{k}" for k in keys])
    raise ValueError(f"unknown metric {name!r}")


def dashboard(tables: dict[str, DataFrame], materialize: str = "checkpoint",
              broadcast_max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """The 48-column dashboard table from the six star tables.

    ``materialize`` picks how the joined base is kept for its two readers
    (the grouping pass and the final join-back):
    ``checkpoint`` (written to the shared checkpoint folder, lineage cut, and
    cleaned up with the frame) or ``none`` (read twice; cheap when the
    calendar join is co-bucketed).
    """
    base = trip_base(tables, broadcast_max_rows)
    if materialize == "checkpoint":
        checkpoint_dir(base.sparkSession)
        base = base.checkpoint(eager=True)
    elif materialize != "none":
        raise ValueError(f"unknown materialize {materialize!r}")
    return labels(aggregate_metrics(base, broadcast_max_rows, materialize == "checkpoint")
                  ).select(*DASHBOARD_COLUMNS)
