"""Timestamp parsing, calendar parts and trip durations (column functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CALENDAR_PARTS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Strings (or timestamps) to a wall-clock timestamp without zone."""
    c = _col(c)
    return F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else c.cast("timestamp_ntz")


def calendar_parts(c: str | Column, prefix: str) -> list[Column]:
    """Hour, day of month, month, year, weekday (Monday = 0) and date.

    All integer parts are bigint, named ``{prefix}_{part}``; the date is
    ``{prefix}_date``.
    """
    c = _col(c)
    exprs = {
        "hour": F.hour(c),
        "day": F.dayofmonth(c),
        "month": F.month(c),
        "year": F.year(c),
        "weekday": F.weekday(c),
    }
    cols = [exprs[p].cast("bigint").alias(f"{prefix}_{p}") for p in CALENDAR_PARTS]
    cols.append(F.to_date(c).alias(f"{prefix}_date"))
    return cols


def whole_minutes(start: str | Column, end: str | Column) -> Column:
    """Complete minutes from start to end, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def fractional_minutes(start: str | Column, end: str | Column) -> Column:
    """Exact minutes from start to end as a double.

    Computed on microseconds of the wall-clock values, so the session time
    zone (and its DST shifts) cannot change the result.
    """
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)).cast("double") / 60e6
