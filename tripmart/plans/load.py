"""One load of raw trips into the warehouse, shared by the monthly job and the
file stream: rejects kept, audits enforced, torn loads noticed.

A month counts as loaded (``operators.months.loaded_months``) only while the
load log says so. The log is set to "loading" before the first table is
replaced and to "loaded" after the audits, so a load that fails between the
calendar and the facts leaves a month that is due again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit
from ..operators.star import build_star, split_rejects
from ..schemas import KEYS, REQUIRED
from ..session import checkpoint_dir
from ..sources import warehouse

# Declared unique; the fact's key is reported by the audit queries but repeats
# in real data (equal trips), so it does not fail a load.
UNIQUE_TABLES = [t for t in KEYS if t != "fact_trips"]


class LoadError(RuntimeError):
    """A load whose result does not add up or breaks a declared key or column."""


def load_trips(spark: SparkSession, trips: DataFrame, zones: DataFrame,
               static: dict[str, DataFrame], root: str, months: list[str]) -> None:
    """Build the star of ``trips`` (which hold ``months``) and replace those
    months; rows that cannot be placed go to the rejects table."""
    checkpoint_dir(spark)
    warehouse.log_months(spark, root, [(m, warehouse.LOADING, None, None, None) for m in months])
    good, rejects = split_rejects(trips)
    warehouse.write_star(build_star(good, zones, static), root)
    warehouse.write_rejects(rejects, root)

    loaded = warehouse.read_star(spark, root)
    for name in warehouse.MONTHLY_TABLES:
        loaded[name] = loaded[name].filter(F.col("year_month").isin(months))

    def by_month(df: DataFrame) -> dict:
        return {r["year_month"]: r["count"] for r in df.groupBy("year_month").count().collect()}

    rows, facts, bad = by_month(trips), by_month(loaded["fact_trips"]), by_month(rejects)
    lost = {m: n - facts.get(m, 0) - bad.get(m, 0) for m, n in rows.items()}
    if any(lost.values()):
        raise LoadError(f"rows in = facts + rejects does not hold: {lost}")
    twice = audit.key_report({t: loaded[t] for t in UNIQUE_TABLES}, KEYS).filter(
        "duplicate_keys > 0").collect()
    missing = audit.required_violations(loaded, REQUIRED).filter("missing > 0").collect()
    if twice or missing:
        raise LoadError(f"duplicate keys {twice}, missing values {missing}")
    warehouse.log_months(spark, root, [
        (m, warehouse.LOADED, rows.get(m, 0), facts.get(m, 0), bad.get(m, 0)) for m in months])
