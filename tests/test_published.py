"""The published warehouse: versions, failures, stable keys, monthly metric state."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.operators import audit
from tripmart.operators import dashboard as dash
from tripmart.operators.keys import assign_key, extend_key
from tripmart.operators.star import build_star
from tripmart.plans import published_load as pl
from tripmart.plans.load import LoadError
from tripmart.session import scratch_path
from tripmart.sources.publish import ConcurrentLoad, Published
from tripmart.sources.static import static_dims

from conftest import SMALL

MONTHS = ["1998-01", "1998-02", "1998-03"]


@pytest.fixture(scope="module")
def landed(spark):
    t = fixtures.trips(spark, SMALL).drop("trip_key").filter(F.col("year_month").isin(MONTHS))
    root, zones = scratch_path(spark, "p-land"), scratch_path(spark, "p-zones")
    t.write.partitionBy("year_month").parquet(root)
    fixtures.zones(spark, SMALL).write.option("header", True).csv(zones)
    return t, root, zones


def rows(df, cols):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r)
                  for r in df.select(*cols).collect())


def load(spark, landed, wh, months):
    return pl.run(spark, landed[1], wh, landed[2], "1998-06-01", layout="partitioned", months=months)


def test_months_one_by_one_equal_the_whole(spark, landed):
    wh = scratch_path(spark, "p-wh")
    load(spark, landed, wh, MONTHS[:2])
    held = Published(spark, wh).star()  # a reader of the first version
    n = held["fact_trips"].count()
    assert pl.pending(spark, landed[1], Published(spark, wh), "1998-06-01",
                      layout="partitioned") == MONTHS[2:]
    load(spark, landed, wh, MONTHS[2:])
    assert held["fact_trips"].count() == n  # still sees its version
    tables = build_star(landed[0], fixtures.zones(spark, SMALL), static_dims(spark))
    star = Published(spark, wh).star()
    for name in star:
        cols = star[name].columns
        assert rows(star[name], cols) == rows(tables[name], cols), name
    got, want = pl.dashboard(Published(spark, wh)), dash.dashboard(tables)
    assert got.columns == want.columns and rows(got, got.columns) == rows(want, got.columns)
    notes = Published(spark, wh).manifest().notes
    assert sum(notes[m]["n_rows"] for m in MONTHS) == landed[0].count()
    counts = {r.table_name: r.row_count for r in pl.table_counts(Published(spark, wh)).collect()}
    assert counts == {t: df.count() for t, df in star.items()}


def test_old_trips_are_not_read_for_the_metrics(spark, landed):
    wh = scratch_path(spark, "p-wh")
    load(spark, landed, wh, MONTHS[:2])
    parts = Published(spark, wh).manifest().tables["fact_trips"]
    files = Published(spark, wh).files
    for month in MONTHS[:2]:  # without their facts and calendar a recompute is impossible
        files.delete(f"{wh}/{parts[month]}")
    load(spark, landed, wh, MONTHS[2:])
    tables = build_star(landed[0], fixtures.zones(spark, SMALL), static_dims(spark))
    got, want = pl.dashboard(Published(spark, wh)), dash.dashboard(tables)
    assert rows(got, got.columns) == rows(want, got.columns)


@pytest.mark.parametrize("table", ["location_dim", "datetime_dim", "dashboard_rows", "metric_state"])
def test_a_failed_load_changes_nothing(spark, landed, monkeypatch, table):
    from tripmart.sources.publish import Load
    wh = scratch_path(spark, "p-fail")
    load(spark, landed, wh, MONTHS[:1])
    before = Published(spark, wh)
    old = before.manifest()
    was = rows(pl.dashboard(before), dash.DASHBOARD_COLUMNS)
    for name in ("write", "write_months"):
        whole = getattr(Load, name)

        def fails(self, t, *args, whole=whole):
            whole(self, t, *args)
            assert Published(spark, wh).manifest() == old  # a reader during the load
            if t == table:
                raise OSError("disk gone")
        monkeypatch.setattr(Load, name, fails)
    with pytest.raises(OSError):
        load(spark, landed, wh, MONTHS[:2])
    assert Published(spark, wh).manifest() == old
    assert rows(pl.dashboard(Published(spark, wh)), dash.DASHBOARD_COLUMNS) == was
    gone = Published(spark, wh).clean(min_age_seconds=0)
    assert len(gone) == 1 and rows(pl.dashboard(Published(spark, wh)), dash.DASHBOARD_COLUMNS) == was


def test_broken_keys_are_not_published(spark, landed):
    wh = Published(spark, scratch_path(spark, "p-bad"))
    zones = fixtures.zones(spark, SMALL)
    with pytest.raises(LoadError, match="location_dim"):
        pl.load_trips(spark, landed[0], zones.unionByName(zones), static_dims(spark), wh, MONTHS)
    assert wh.versions() == []


def test_rejects_dimension_changes_and_missing_values(spark, landed):
    bad = F.col("PULocationID") % 7 == 0
    t = landed[0].withColumn("tpep_pickup_datetime", F.when(~bad, F.col("tpep_pickup_datetime")))
    zones = fixtures.zones(spark, SMALL)
    wh = Published(spark, scratch_path(spark, "p-rej"))
    pl.load_trips(spark, t, zones, static_dims(spark), wh, MONTHS)
    rejects = wh.read("rejects", pl.REJECTS_SCHEMA)
    cols = rejects.columns
    assert rows(rejects, cols) == rows(t.filter(bad).withColumn(
        "reject_reason", F.lit("no pickup time")), cols)
    seen = wh.manifest().notes["last load"]
    want = audit.null_counts(t, ["VendorID", "passenger_count"]).first()
    assert (seen["missing_VendorID"], seen["missing_passenger_count"]) == tuple(want)
    renamed = zones.withColumn("Zone", F.concat(F.lit("new "), "Zone"))
    one = t.filter(F.col("year_month") == MONTHS[0])
    pl.load_trips(spark, one, renamed, static_dims(spark), wh, MONTHS[:1])
    zone = {r[0] for r in pl.dashboard(wh).select("pickup_Zone").distinct().collect()}
    assert all(z is None or z.startswith("new ") for z in zone)  # of all months


def test_late_rows_change_no_key(spark, landed):
    wh = Published(spark, scratch_path(spark, "p-late"))
    zones, static = fixtures.zones(spark, SMALL), static_dims(spark)
    first = landed[0].filter("fare_amount > 20000")
    pl.load_trips(spark, first, zones, static, wh, MONTHS)
    key = ["year_month", "tpep_pickup_datetime", "tpep_dropoff_datetime"]
    before = {tuple(r[c] for c in key): r["datetime_id"] for r in wh.read("datetime_dim").collect()}
    pl.load_trips(spark, landed[0], zones, static, wh, MONTHS)
    after = {tuple(r[c] for c in key): r["datetime_id"] for r in wh.read("datetime_dim").collect()}
    assert before and len(after) > len(before) and all(after[k] == v for k, v in before.items())
    for m in MONTHS:
        ids = sorted(v for k, v in after.items() if k[0] == m)
        assert ids == list(range(len(ids)))
    assert wh.star()["fact_trips"].count() == landed[0].count()


def test_extend_key_without_groups_and_on_nothing(spark):
    rows_ = spark.createDataFrame([(5,), (3,), (3,), (9,)], "x long")
    none = spark.createDataFrame([], "x long, id long")
    first = extend_key(none, rows_, ["x"], "id")
    assert {r.x: r.id for r in first.collect()} == {3: 0, 5: 1, 9: 2}
    more = extend_key(first, spark.createDataFrame([(1,), (9,), (7,)], "x long"), ["x"], "id")
    assert {r.x: r.id for r in more.collect()} == {1: 3, 7: 4}
    assert assign_key(rows_, ["x"], "id", distinct=True).count() == 3


def test_concurrent_loads(spark):
    wh = Published(spark, scratch_path(spark, "p-two"))
    frame = lambda m, v: spark.createDataFrame([(v, m)], "VendorID long, year_month string")
    a, b, c = wh.begin(), wh.begin(), wh.begin()
    a.write_months("fact_trips", frame("2024-01", 1), ["2024-01"])
    b.write_months("fact_trips", frame("2024-02", 2), ["2024-02"])
    c.write_months("fact_trips", frame("2024-01", 3), ["2024-01"])
    a.publish()
    b.publish()  # another month: both stay
    with pytest.raises(ConcurrentLoad):
        c.publish()
    assert sorted(tuple(r) for r in wh.read("fact_trips").select("VendorID", "year_month").collect()
                  ) == [(1, "2024-01"), (2, "2024-02")]
    with pytest.raises(ValueError, match="other months"):
        wh.begin().write_months("fact_trips", frame("2024-05", 1), ["2024-01"])
    empty = wh.begin()
    empty.write_months("fact_trips", frame("2024-01", 1).limit(0), ["2024-01"])
    empty.publish()
    assert [r.year_month for r in wh.read("fact_trips").collect()] == ["2024-02"]


def test_footer_counts_read_no_column(spark, landed):
    df = audit.footer_counts(spark, {"a": [landed[1]], "b": []})
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan
    assert {r.table_name: r.row_count for r in df.collect()} == {"a": landed[0].count(), "b": 0}
    by = audit.footer_counts_by(spark, [f"{landed[1]}/year_month={m}" for m in MONTHS], "year_month", landed[1])
    plan = by._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan and "PushedGroupBy: [year_month]" in plan
    want = {r.year_month: r["count"] for r in landed[0].groupBy("year_month").count().collect()}
    assert {r.year_month: r.row_count for r in by.collect()} == want


EVENT_LOG = """
import json, sys
sys.path.insert(0, {repo!r})
from tripmart.session import build_session
spark = build_session("local[4]", 4, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.dir": "file://" + {log!r}}})
from tripmart.plans import published_load
published_load.run(spark, {landing!r}, {wh!r}, {zones!r}, "1998-06-01", layout="partitioned")
spark.stop()
"""


def test_raw_months_are_read_twice(spark, landed, tmp_path):
    import os
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    wh = f"file://{tmp_path}/wh"
    (tmp_path / "log").mkdir()
    code = EVENT_LOG.format(repo=repo, log=str(tmp_path / "log"), landing=landed[1], wh=wh, zones=landed[2])
    child = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert child.returncode == 0, child.stderr[-2000:]
    scans, read = set(), 0
    events = [json.loads(x) for p in (tmp_path / "log").iterdir() for x in p.open()]

    def walk(node):
        where = str(node.get("metadata", {}).get("Location", ""))
        if "Scan parquet" in node["nodeName"] and "p-land" in where:
            scans.update(m["accumulatorId"] for m in node["metrics"] if m["name"] == "number of output rows")
        for x in node["children"]:
            walk(x)

    for e in events:
        if "sparkPlanInfo" in e:
            walk(e["sparkPlanInfo"])
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd":
            read += sum(int(a["Update"]) for a in e["Task Info"].get("Accumulables", [])
                        if a["ID"] in scans and str(a.get("Update")).isdigit())
    n = landed[0].count()
    assert n < read <= 2 * n
