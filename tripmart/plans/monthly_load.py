"""The monthly warehouse job: pick the due months, load each once, refresh
the dashboard. Batch counterpart of ``streaming.ingest`` for schedulers that
call a function rather than run a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..operators import dashboard as dash
from ..operators import months as mon
from ..schemas import ZONE_LOOKUP
from ..sources import files, warehouse
from ..sources.static import static_dims
from .load import load_trips


def loaded(spark: SparkSession, warehouse_root: str,
           months: list[str] | None = None) -> DataFrame:
    """M3: months in the warehouse (empty before the first load), of ``months``
    if given: only their partitions are then read. A month whose last load
    did not finish is not in the result."""
    try:
        fact = warehouse.read_table(spark, warehouse_root, "fact_trips")
        dim = warehouse.read_table(spark, warehouse_root, "datetime_dim")
    except AnalysisException:  # no tables written yet
        return spark.createDataFrame([], "year_month string, n_facts bigint")
    if months is not None:
        fact, dim = (t.filter(F.col("year_month").isin(months)) for t in (fact, dim))
    torn = warehouse.read_log(spark, warehouse_root).filter(
        F.col("state") != warehouse.LOADED).select("year_month")
    return mon.loaded_months(fact, dim).join(torn, "year_month", "left_anti")


def pending(spark: SparkSession, landing_root: str, warehouse_root: str, as_of: str,
            year: int | None = None, lag: int = 2, layout: str = "files") -> list[str]:
    """M1-M4: months published by ``as_of`` that have landed and are not loaded
    yet (a handful of month names). A due month that is too small raises."""
    landed = files.landed_months(spark, landing_root, layout)
    candidates = mon.eligible(landed, as_of, lag, year)
    names = sorted(r.year_month for r in candidates.collect())  # a few month names
    due = mon.pending_months(candidates, landed, loaded(spark, warehouse_root, names))
    return files.require_accepted(landed, [r.year_month for r in due.collect()])


def load_months(spark: SparkSession, landing_root: str, warehouse_root: str, zones_csv: str,
                months: list[str], layout: str = "files") -> None:
    """S1 + star build + S4 for the given months (each replaced, never appended)."""
    if not months:
        return
    trips = files.read_trips(spark, landing_root, months, layout=layout)
    zones = files.read_lookup(spark, zones_csv, ZONE_LOOKUP)
    load_trips(spark, trips, zones, static_dims(spark), warehouse_root, months)


def run(spark: SparkSession, landing_root: str, warehouse_root: str, zones_csv: str,
        as_of: str, year: int | None = None, lag: int = 2, layout: str = "files",
        dashboard_path: str | None = None) -> list[str]:
    """One scheduled run: load what is due, then rebuild the dashboard table."""
    due = pending(spark, landing_root, warehouse_root, as_of, year, lag, layout)
    load_months(spark, landing_root, warehouse_root, zones_csv, due, layout)
    if dashboard_path and due:
        star = warehouse.read_star(spark, warehouse_root)
        warehouse.save_table(dash.dashboard(star), dashboard_path)
    return due


def month_counts(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """Facts per month in the warehouse (for reports and tests)."""
    fact = warehouse.read_table(spark, warehouse_root, "fact_trips")
    return fact.groupBy("year_month").agg(F.count(F.lit(1)).alias("n"))
