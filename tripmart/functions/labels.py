"""Per-row derived metrics and labels of the dashboard (column functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts of the dashboard.
MORNING_RUSH = "Morning Rush"
EVENING_RUSH = "Evening Rush"
NIGHT = "Night"
OFF_PEAK = "Off Peak"
DISTANCE_LABELS = ["Very Short", "Short", "Medium", "Long", "Very Long"]
# Upper bounds (inclusive, miles) of the first four distance labels.
DISTANCE_BOUNDS = [1, 3, 5, 10]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_tip(tip: str | Column) -> Column:
    """1 when a tip was given, else 0 (also for NULL)."""
    return F.when(_col(tip) > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def fare_per_mile(fare: str | Column, distance: str | Column) -> Column:
    """Fare / distance, 0.0 when the distance is not positive."""
    d = _col(distance)
    return F.when(d > 0, _col(fare) / d).otherwise(F.lit(0.0)).cast("double")


def time_period(hour: str | Column) -> Column:
    """Rush-hour label of an hour of day; NULL falls to 'Off Peak'."""
    h = _col(hour)
    return (F.when(h.between(6, 10), F.lit(MORNING_RUSH))
            .when(h.between(16, 19), F.lit(EVENING_RUSH))
            .when((h >= 23) | (h <= 4), F.lit(NIGHT))
            .otherwise(F.lit(OFF_PEAK)))


def distance_category(distance: str | Column) -> Column:
    """Distance label; NULL falls to the last label."""
    d = _col(distance)
    expr = None
    for bound, label in zip(DISTANCE_BOUNDS, DISTANCE_LABELS):
        expr = (F.when(d <= bound, F.lit(label)) if expr is None
                else expr.when(d <= bound, F.lit(label)))
    return expr.otherwise(F.lit(DISTANCE_LABELS[-1]))


def as_group_key(c: str | Column) -> Column:
    """A number as a string grouping key (as the dashboard SQL does)."""
    return _col(c).cast("string")
