"""The monthly job on a published warehouse: every run is all or nothing.

One run stages, checks and then publishes, as one new version
(``sources.publish``): the calendar, the facts and rejects, the dimensions, the
kept trips of the dashboard and the metric state of the loaded months. A run that
fails at any point leaves the version before, whole.

The raw months are read twice: for their distinct (pickup, dropoff) pairs, and
for the one write that gives facts and rejects. Row counts come from Parquet
footers, and missing values (A4) are counted by an observation on that write.

Calendar keys are stable: pairs that had a key keep it, pairs that come with late
rows get the next numbers of their month (``operators.keys.extend_key``).

The dashboard is never rebuilt from trips of earlier months: loaded months are
joined and summarised, all others stay as published. Only a change of a
dimension's rows makes all months' kept trips anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import audit, dashboard as dash, metric_state
from ..operators import months as mon
from ..operators import star as st
from ..operators.keys import extend_key
from ..schemas import (DATETIME_DIM, DIMENSION_TABLES, FACT_COLUMNS, KEYS, RAW_TRIPS,
                       REQUIRED, ZONE_LOOKUP)
from ..session import checkpoint_dir, shuffles_released
from ..sources import files
from ..sources.publish import Load, Manifest, Published
from ..sources.static import static_dims
from .load import UNIQUE_TABLES, LoadError

LOADED_ROWS, REJECTS = "loaded_rows", "rejects"
BASE, STATE = "dashboard_rows", "metric_state"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a month
MONTH = "year_month"
MISSING = "_missing"
RAW_FACT_COLUMNS = [c for c in FACT_COLUMNS if c in {f.name for f in RAW_TRIPS.fields}]
REJECTS_SCHEMA = T.StructType([*RAW_TRIPS.fields, T.StructField(MONTH, T.StringType()),
                               T.StructField("reject_reason", T.StringType())])


def new_keys(load: Load, trips: DataFrame, months: list[str]) -> DataFrame:
    """The calendar of the loaded months: keys given before, and those of new pairs."""
    before = load.warehouse.read("datetime_dim", DATETIME_DIM, load.base, months)
    good, _ = st.split_rejects(trips)
    added = extend_key(before, good.select(MONTH, st.PICKUP, st.DROPOFF), [st.PICKUP, st.DROPOFF],
                       "datetime_id", [MONTH])
    return before.unionByName(st.calendar_columns(added))


def _missing_bits(rows: DataFrame, columns: list[str]) -> Column:
    """A number with a bit for each of ``columns``: whether its raw value is missing."""
    return sum((F.when(audit._missing(rows, f"_raw_{c}"), 1 << k).otherwise(0).cast("bigint")
                for k, c in enumerate(columns)), F.lit(0).cast("bigint"))


def outcome_rows(trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every raw row once, as a fact (missing values filled) or a reject (as it came); which
    of ``RAW_FACT_COLUMNS`` were missing is kept as bits, not as a second copy of the row."""
    keys = calendar.select(MONTH, st.PICKUP, st.DROPOFF, "datetime_id")
    rows = trips.withColumn("reject_reason", st.reject_reason()).join(
        keys, [MONTH, st.PICKUP, st.DROPOFF], "left")
    raw = {f.name: f.dataType for f in RAW_TRIPS.fields}
    shared = RAW_FACT_COLUMNS
    is_fact = F.col("reject_reason").isNull()
    rows = st.fill_missing(rows.select("*", *[F.col(c).alias(f"_raw_{c}") for c in shared]))
    own = {c: F.when(is_fact, F.col(c)).otherwise(F.col(f"_raw_{c}").cast(raw[c])) for c in shared}
    own |= {c: F.when(~is_fact, F.col(c)) for c in (st.PICKUP, st.DROPOFF)}
    return rows.select(
        *[own.get(c, F.col(c)).alias(c) for c in [*FACT_COLUMNS, st.PICKUP, st.DROPOFF]],
        _missing_bits(rows, shared).alias(MISSING), "reject_reason",
        F.when(is_fact, "fact").otherwise("reject").alias("outcome"), MONTH)


def _write_outcomes(load: Load, trips: DataFrame, months: list[str]) -> dict:
    """Write facts and rejects in one pass; what the observation saw of it."""
    seen = Observation()
    rows = outcome_rows(trips, load.read("datetime_dim", DATETIME_DIM, months))
    rows = rows.hint("rebalance", F.col("outcome"), F.col(MONTH)).observe(
        seen, F.count_if(F.col("outcome") == "fact").alias("facts"),
        F.count_if(F.col("outcome") == "reject").alias("rejects"),
        F.count_if((F.col("outcome") == "fact") & F.col("datetime_id").isNull()).alias("without_key"),
        *[F.count_if(F.col(MISSING).bitwiseAND(F.lit(1 << k)) != 0).alias(f"missing_{c}")
          for k, c in enumerate(RAW_FACT_COLUMNS)])
    where = f"{load.folder}/table={LOADED_ROWS}"
    rows.drop(MISSING).write.partitionBy("outcome", MONTH).parquet(f"{load.warehouse.root}/{where}")
    load.take_months("fact_trips", f"{where}/outcome=fact", months)
    load.take_months(REJECTS, f"{where}/outcome=reject", [*months, NO_MONTH])
    return seen.get


def _footer_rows(warehouse: Published, manifest: Manifest, table: str, months: list[str]) -> dict:
    parts = manifest.tables.get(table, {})
    folders = [f"{warehouse.root}/{parts[m]}" for m in months if m in parts]
    if not folders:
        return {}
    counted = audit.footer_counts_by(warehouse.spark, folders, MONTH, warehouse.root)
    return {r[MONTH] or NO_MONTH: r["row_count"] for r in counted.collect()}


def _check(load: Load, months: list[str], rows_in: dict, seen: dict) -> None:
    """Note the loaded months, or raise if something does not add up."""
    staged = load.staged()
    facts, rejects = (_footer_rows(load.warehouse, staged, t, [*months, NO_MONTH])
                      for t in ("fact_trips", REJECTS))
    lost = {m: n - facts.get(m, 0) - rejects.get(m, 0) for m, n in rows_in.items()}
    if any(lost.values()) or seen["without_key"]:
        raise LoadError(f"rows in = facts + rejects does not hold: {lost}, "
                        f"{seen['without_key']} facts without a calendar key")
    tables = {t: load.read(t, months=months) for t in UNIQUE_TABLES}
    twice = audit.key_report(tables, KEYS).filter("duplicate_keys > 0").collect()
    missing = audit.required_violations(tables, REQUIRED).filter("missing > 0").collect()
    if twice or missing:
        raise LoadError(f"duplicate keys {twice}, missing values {missing}")
    for m in months:
        load.notes[m] = {"n_rows": rows_in.get(m, 0), "n_facts": facts.get(m, 0),
                         "n_rejects": rejects.get(m, 0)}
    load.notes["last load"] = {"months": months, **{k: v for k, v in seen.items()}}


def _same_rows(a: DataFrame, b: DataFrame) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def load_trips(spark: SparkSession, trips: DataFrame, zones: DataFrame, static: dict[str, DataFrame],
               warehouse: Published, months: list[str], rows_in: dict | None = None) -> Manifest:
    """Publish one version with ``months`` replaced by the rows of ``trips``.

    ``rows_in``: rows of each month if known (from footers); counted otherwise."""
    checkpoint_dir(spark)
    with shuffles_released(spark):
        return _load_trips(spark, trips, zones, static, warehouse, months, rows_in)


def _load_trips(spark: SparkSession, trips: DataFrame, zones: DataFrame, static: dict[str, DataFrame],
                warehouse: Published, months: list[str], rows_in: dict | None) -> Manifest:
    load = warehouse.begin()
    for name, df in {**static, "location_dim": zones.select(
            F.col("LocationID").cast("bigint").alias("LocationID"), "Borough", "Zone",
            "service_zone")}.items():
        load.write(name, df)
    load.write_months("datetime_dim", new_keys(load, trips, months), months)
    seen = _write_outcomes(load, trips, months)
    if rows_in is None:
        rows_in = {r[MONTH] or NO_MONTH: r["count"] for r in trips.groupBy(MONTH).count().collect()}
    _check(load, months, rows_in, seen)

    known = sorted(load.staged().tables.get("fact_trips", {}))
    same = bool(load.base.version) and all(_same_rows(
        warehouse.read(t, manifest=load.base), load.read(t)) for t in DIMENSION_TABLES)
    again = months if same else sorted({*months, *known})
    base = dash.trip_base(load.star(again), keep=(MONTH,))
    load.write_months(BASE, base, again)
    load.write_months(STATE, metric_state.month_state(load.read(BASE, base.schema, again)), again)
    return load.publish()


def dashboard(warehouse: Published, manifest: Manifest | None = None) -> DataFrame:
    """The dashboard of one version: published kept trips, metrics of the states."""
    checkpoint_dir(warehouse.spark)
    manifest = manifest or warehouse.manifest()
    return metric_state.dashboard(warehouse.read(BASE, manifest=manifest),
                                  warehouse.read(STATE, metric_state.SCHEMA, manifest))


def save_dashboard(warehouse: Published) -> Manifest:
    """Create or replace the wide table itself, published like any other."""
    load = warehouse.begin()
    load.write("dashboard", dashboard(warehouse, load.base))
    return load.publish()


def table_counts(warehouse: Published) -> DataFrame:
    """A2/Q1: rows of the six star tables of the newest version, from footers."""
    parts = warehouse.manifest().tables
    return audit.footer_counts(warehouse.spark, {
        t: [f"{warehouse.root}/{f}" for f in sorted(parts.get(t, {}).values())]
        for t in [*DIMENSION_TABLES, "datetime_dim", "fact_trips"]}, warehouse.root)


def pending(spark: SparkSession, landing_root: str, warehouse: Published, as_of: str,
            year: int | None = None, lag: int = 2, layout: str = "files") -> list[str]:
    """M1-M4: months published by ``as_of`` that have landed and are in no version."""
    landed = files.landed_months(spark, landing_root, layout)
    candidates = mon.eligible(landed, as_of, lag, year)
    done = list(warehouse.manifest().notes)
    return files.require_accepted(landed, [r[MONTH] for r in candidates.filter(
        ~F.col(MONTH).isin(done) if done else F.lit(True)).collect()])


def run(spark: SparkSession, landing_root: str, warehouse_root: str, zones_csv: str, as_of: str,
        year: int | None = None, lag: int = 2, layout: str = "files",
        months: list[str] | None = None) -> list[str]:
    """One scheduled run: publish the due months (or the given ones) in one version."""
    warehouse = Published(spark, warehouse_root)
    due = months or pending(spark, landing_root, warehouse, as_of, year, lag, layout)
    if due:
        counted = audit.footer_counts(spark, {
            m: [files.month_path(landing_root, m, layout)] for m in due}).collect()
        load_trips(spark, files.read_trips(spark, landing_root, due, layout=layout),
                   files.read_lookup(spark, zones_csv, ZONE_LOOKUP), static_dims(spark), warehouse, due,
                   {r["table_name"]: r["row_count"] for r in counted})
    return due
