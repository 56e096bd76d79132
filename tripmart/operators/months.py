"""Which months to load (M1-M4), as small DataFrames of ``year_month``.

``as_of`` is always a parameter (never the clock), so a result is
reproducible. Month strings are ``YYYY-MM``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first_day(ym: str = "year_month"):
    return F.to_date(F.concat(F.col(ym), F.lit("-01")))


def latest_available(as_of: str, lag: int = 2):
    """The newest month published ``lag`` months before ``as_of`` (a date)."""
    return F.add_months(F.to_date(F.lit(as_of)), -lag)


def available_months(years: DataFrame, as_of: str, lag: int = 2,
                     year_col: str = "year") -> DataFrame:
    """M1: for each year in ``years``, its months published by ``as_of``.

    As in the scheduled job this mirrors, a year only has months when the
    latest published month lies inside that year; the list then runs from
    January to that month.
    """
    latest = latest_available(as_of, lag)
    y = years.select(F.col(year_col).cast("int").alias("_y")).distinct()
    y = y.filter(F.year(latest) == F.col("_y"))
    first = F.make_date(F.col("_y"), F.lit(1), F.lit(1))
    last = F.make_date(F.col("_y"), F.month(latest), F.lit(1))
    months = y.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("_d"))
    return months.select(F.date_format("_d", "yyyy-MM").alias("year_month"))


def eligible(months: DataFrame, as_of: str, lag: int = 2, year: int | None = None) -> DataFrame:
    """M2: months published by ``as_of`` (first day <= as_of - lag months),
    optionally of one target year."""
    cond = _first_day() <= latest_available(as_of, lag)
    if year is not None:
        cond = cond & (F.substring("year_month", 1, 4).cast("int") == F.lit(year))
    return months.select("year_month").distinct().filter(cond)


def loaded_months(fact: DataFrame, datetime_dim: DataFrame) -> DataFrame:
    """Months with at least one fact joined to its calendar row.

    Counts every month in one pass: (year_month, n_facts), n_facts > 0.
    """
    joined = fact.select("year_month", "datetime_id").join(
        datetime_dim.select("year_month", "datetime_id"), on=["year_month", "datetime_id"])
    return joined.groupBy("year_month").agg(F.count(F.lit(1)).alias("n_facts")) \
        .filter(F.col("n_facts") > 0)


def pending_months(candidates: DataFrame, present: DataFrame, loaded: DataFrame) -> DataFrame:
    """M4: candidate months that have a raw file and are not loaded yet."""
    return (candidates.select("year_month").distinct()
            .join(present.select("year_month"), "year_month", "left_semi")
            .join(loaded.select("year_month"), "year_month", "left_anti"))
