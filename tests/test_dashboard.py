"""Dashboard semantics on hand-made rows, and the two plans agree."""

import datetime as dt

from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.functions import labels as lab
from tripmart.operators import dashboard as dash
from tripmart.operators.star import build_star
from tripmart.schemas import RAW_TRIPS
from tripmart.sources.static import static_dims

from conftest import SMALL
from window_plan import window_dashboard


def _trip(pu, do, pax=1.0, dist=2.0, fare=10.0, total=12.0, tip=1.0, vendor=1, rate=1,
          pay=1, pul=1, dol=2):
    return (vendor, pu, do, pax, dist, rate, "N", pul, dol, pay, fare, 0.5, 0.5, tip, 0.0,
            1.0, total, 2.5, 0.0)


def _zones(spark):
    return spark.createDataFrame(
        [(1, "Manhattan", "Midtown", "Yellow Zone"), (2, None, None, "Boro Zone"),
         (3, "Queens", None, "Airports")],
        "LocationID bigint, Borough string, Zone string, service_zone string")


def _star(spark, rows):
    raw = spark.createDataFrame(rows, RAW_TRIPS).withColumn("year_month", F.lit("2024-01"))
    return build_star(raw, _zones(spark), static_dims(spark))


def test_labels_boundaries(spark):
    hours = [None, 0, 4, 5, 6, 10, 11, 15, 16, 19, 20, 22, 23]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = dict(df.select("h", lab.time_period("h").alias("p")).collect())
    assert got[None] == "Off Peak" and got[0] == "Night" and got[4] == "Night"
    assert got[5] == "Off Peak" and got[6] == "Morning Rush" and got[10] == "Morning Rush"
    assert got[11] == "Off Peak" and got[15] == "Off Peak" and got[16] == "Evening Rush"
    assert got[19] == "Evening Rush" and got[20] == "Off Peak" and got[22] == "Off Peak"
    assert got[23] == "Night"
    dists = [None, 0.5, 1.0, 1.01, 3.0, 5.0, 10.0, 10.5]
    df = spark.createDataFrame([(x,) for x in dists], "d double")
    got = dict(df.select("d", lab.distance_category("d").alias("c")).collect())
    assert got[None] == "Very Long" and got[1.0] == "Very Short" and got[1.01] == "Short"
    assert got[3.0] == "Short" and got[5.0] == "Medium" and got[10.0] == "Long"
    assert got[10.5] == "Very Long"


def test_null_zone_is_one_group_and_unmatched_keys_drop(spark):
    t0 = dt.datetime(2024, 1, 3, 8, 0, 0)
    rows = [
        _trip(t0, t0 + dt.timedelta(minutes=10), pul=2, dol=2),
        _trip(t0, t0 + dt.timedelta(minutes=11), pul=2, dol=1),
        _trip(t0, t0 + dt.timedelta(minutes=12), pul=1, dol=3),
        _trip(t0, t0 + dt.timedelta(minutes=13), pul=99),           # unknown zone
        _trip(t0, t0 + dt.timedelta(minutes=14), vendor=None),      # filled 0 -> dropped
        _trip(t0, t0 + dt.timedelta(minutes=15), pax=float("nan")),  # NaN -> 0 -> filtered
        _trip(t0, t0 - dt.timedelta(minutes=3)),                    # negative duration kept
    ]
    tables = _star(spark, rows)
    for method in (dash.dashboard, window_dashboard):
        out = method(tables).collect()
        assert len(out) == 4
        by_pickup = {(r.pickup_Borough, r.pickup_Zone): r.pickup_trips_per_zone for r in out}
        assert by_pickup[(None, None)] == 2
        assert by_pickup[("Manhattan", "Midtown")] == 2
        assert sorted(r.trip_duration_minutes for r in out) == [-3, 10, 11, 12]


def test_plans_agree_on_fixture(spark):
    tables = build_star(fixtures.trips(spark, SMALL), fixtures.zones(spark, SMALL),
                        static_dims(spark))
    cols = dash.DASHBOARD_COLUMNS
    r = [F.round(c, 6).alias(c) if c.startswith(("avg", "median")) else F.col(c) for c in cols]
    w = window_dashboard(tables).select(*r)
    for keep in ("checkpoint", "none"):
        a = dash.dashboard(tables, materialize=keep).select(*r)
        assert a.count() == w.count() > 0
        assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0


def test_aggregate_plan_has_no_window_or_single_partition_base(spark):
    from tripmart.session import scratch_path
    from tripmart.sources import warehouse
    root = scratch_path(spark, "t-plan")
    warehouse.write_star(build_star(fixtures.trips(spark, SMALL), fixtures.zones(spark, SMALL),
                                    static_dims(spark)), root)
    tables = warehouse.read_star(spark, root)
    plan = dash.dashboard(tables, materialize="none")._jdf.queryExecution() \
        .executedPlan().toString()
    # windows only over the small value-frequency and bucket tables of the medians
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert all("_n" in line or "_total" in line for line in windows)
    window_plan = window_dashboard(tables)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SinglePartition" in window_plan


def test_quality_filter_reaches_the_fact_scan(spark):
    from tripmart.session import scratch_path
    from tripmart.sources import warehouse
    root = scratch_path(spark, "t-push")
    warehouse.write_star(build_star(fixtures.trips(spark, SMALL), fixtures.zones(spark, SMALL),
                                    static_dims(spark)), root)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = dash.trip_base(warehouse.read_star(spark, root))._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    fact_scan = [line for line in plan.splitlines()
                 if "FileScan parquet" in line and "fare_amount" in line and "VendorID" in line]
    assert fact_scan, plan
    for pushed in ("GreaterThan(trip_distance,0.0)", "GreaterThan(fare_amount,0.0)",
                   "GreaterThan(total_amount,0.0)", "LessThanOrEqual(passenger_count,6.0)"):
        assert any(pushed in line for line in fact_scan), pushed
    # only the needed columns of the calendar are read
    cal_scan = [line for line in plan.splitlines()
                if "FileScan parquet" in line and "pickup_hour" in line]
    assert cal_scan and all("pickup_date:" not in line for line in cal_scan)


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.integers(0, 23), st.integers(-5, 90), st.sampled_from([None, 0.0, 1.0, 2.0, 7.0]),
    st.sampled_from([0.0, 0.5, 1.0, 3.0, 5.0, 12.0]), st.sampled_from([-3.0, 0.0, 7.5, 20.0]),
    st.sampled_from([0.0, 1.0, 2.5]), st.sampled_from([1, 2, 3, 99]),
    st.sampled_from([1, 2, 3]), st.sampled_from([None, 1, 2, 4]), st.sampled_from([1, 2, 7])),
    min_size=1, max_size=30))
def test_aggregate_plan_equals_window_plan(spark, rows):
    base = dt.datetime(2024, 1, 1)
    trips = [_trip(base + dt.timedelta(hours=h), base + dt.timedelta(hours=h, minutes=m),
                   pax=pax, dist=dist, fare=fare, tip=tip, pul=pul, dol=dol, vendor=vendor,
                   rate=rate)
             for h, m, pax, dist, fare, tip, pul, dol, vendor, rate in rows]
    tables = _star(spark, trips)
    cols = dash.DASHBOARD_COLUMNS
    r = [F.round(c, 6).alias(c) if c.startswith(("avg", "median")) else F.col(c) for c in cols]
    a = dash.dashboard(tables).select(*r)
    w = window_dashboard(tables).select(*r)
    assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0
