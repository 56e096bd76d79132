"""Training inputs: trips with durations (D10, F2), demand counts (A1) and
their location look-up (J5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import fractional_minutes
from .joins import checked_broadcast

DEMAND_KEYS = ["pickup_location_id", "pickup_hour", "pickup_weekday", "pickup_date"]


def with_duration(df: DataFrame, pickup: str = "tpep_pickup_datetime",
                  dropoff: str = "tpep_dropoff_datetime") -> DataFrame:
    """D10 + F2 + D2: exact minutes, trips with a positive duration only,
    and the pickup hour, weekday (Monday = 0) and date."""
    return (df.withColumn("trip_duration", fractional_minutes(pickup, dropoff))
            .filter(F.col("trip_duration") > 0)
            .withColumn("pickup_hour", F.hour(pickup).cast("bigint"))
            .withColumn("pickup_weekday", F.weekday(pickup).cast("bigint"))
            .withColumn("pickup_date", F.to_date(pickup)))


def demand(df: DataFrame, keys: Sequence[str] = DEMAND_KEYS) -> DataFrame:
    """A1: trips per (location, hour, weekday, date) as ``trip_count``.

    Rows with a NULL key are left out, as a pandas group-by does. Counting is
    partial per task before the shuffle, so a busy location only adds one
    row per task to the exchange.
    """
    keys = list(keys)
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"))


def demand_with_location(counts: DataFrame, locations: DataFrame,
                         key: str = "pickup_location_id",
                         broadcast_max_rows: int = 1_000_000) -> DataFrame:
    """Add the location's attributes to every demand row (left join)."""
    return counts.join(checked_broadcast(locations, broadcast_max_rows), on=key, how="left")
