"""Loads are re-run safe; months; sampling; streaming ingest equals batch;
the monthly job; the co-bucketed catalog layout."""

from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.functions.hashing import hash_sample, hash_split
from tripmart.operators import months as M
from tripmart.operators.star import build_star
from tripmart.session import scratch_path
from tripmart.sources import warehouse
from tripmart.sources.static import static_dims

from conftest import SMALL
from window_plan import window_dashboard


def test_loading_a_month_twice_changes_nothing(spark):
    tables = build_star(fixtures.trips(spark, SMALL), fixtures.zones(spark, SMALL),
                        static_dims(spark))
    root = scratch_path(spark, "t-load")
    warehouse.write_star(tables, root)
    once = warehouse.read_table(spark, root, "fact_trips").count()
    warehouse.write_star(tables, root)
    assert warehouse.read_table(spark, root, "fact_trips").count() == once
    one_month = tables["fact_trips"].filter(F.col("year_month") == "1998-01")
    warehouse.load_monthly(one_month, root, "fact_trips")
    assert warehouse.read_table(spark, root, "fact_trips").count() == once


def test_sample_and_split_do_not_depend_on_partitions(spark):
    t = fixtures.trips(spark, SMALL)
    a = {r.trip_key for r in hash_sample(t.repartition(1), "trip_key").collect()}
    b = {r.trip_key for r in hash_sample(t.repartition(13), "trip_key").collect()}
    assert a == b and 0.6 < len(a) / t.count() < 0.8
    train, test = hash_split(t, "trip_key")
    assert train.count() + test.count() == t.count()
    assert train.join(test, "trip_key").count() == 0


def test_months(spark):
    years = spark.createDataFrame([(2024,), (2023,)], "year int")
    got = [r.year_month for r in M.available_months(years, "2024-05-20").collect()]
    assert sorted(got) == ["2024-01", "2024-02", "2024-03"]
    assert M.available_months(years, "2025-03-01").count() == 0
    months = spark.createDataFrame([(m,) for m in ["2024-01", "2024-03", "2024-04", "2023-12"]],
                                   "year_month string")
    el = sorted(r.year_month for r in M.eligible(months, "2024-05-20", 2, 2024).collect())
    assert el == ["2024-01", "2024-03"]
    loaded = spark.createDataFrame([("2024-01",)], "year_month string")
    pend = M.pending_months(M.eligible(months, "2024-05-20", 2, 2024), months, loaded)
    assert [r.year_month for r in pend.collect()] == ["2024-03"]


def test_streaming_ingest_equals_batch_and_rerun_is_noop(spark):
    from tripmart.streaming.ingest import ingest_available
    t = fixtures.trips(spark, SMALL).drop("trip_key")
    landing, wh, ckpt = (scratch_path(spark, n) for n in ("land", "wh", "ck"))
    early = t.filter(F.col("year_month") < "1997-01")
    early.write.partitionBy("year_month").parquet(landing)
    glob = f"{landing}/year_month=*/*.parquet"
    args = (landing, wh, ckpt, fixtures.zones(spark, SMALL), static_dims(spark))
    ingest_available(spark, glob, *args, max_files_per_trigger=50)
    first = warehouse.read_table(spark, wh, "fact_trips").count()
    assert first == early.count()
    t.filter(F.col("year_month") >= "1997-01").write.mode("append") \
        .partitionBy("year_month").parquet(landing)
    ingest_available(spark, glob, *args, max_files_per_trigger=50)
    ingest_available(spark, glob, *args, max_files_per_trigger=50)
    assert warehouse.read_table(spark, wh, "fact_trips").count() == t.count()



def test_bucketed_star_joins_calendar_without_shuffle(spark):
    import uuid
    from tripmart.operators import dashboard as dash
    db = f"t_{uuid.uuid4().hex[:8]}"
    tables = build_star(fixtures.trips(spark, SMALL), fixtures.zones(spark, SMALL),
                        static_dims(spark))
    warehouse.save_star_tables(tables, db, buckets=4, location=scratch_path(spark, "t-db"))
    n = warehouse.read_catalog_star(spark, db)["fact_trips"].count()
    # reloading one month replaces it
    warehouse.save_star_tables({"fact_trips": tables["fact_trips"].filter(
        F.col("year_month") == "1998-01")}, db, buckets=4)
    star = warehouse.read_catalog_star(spark, db)
    assert star["fact_trips"].count() == n
    old = {k: spark.conf.get(k) for k in ("spark.sql.requireAllClusterKeysForCoPartition",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = star["fact_trips"].join(star["datetime_dim"], ["year_month", "datetime_id"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == n
        out = dash.dashboard(star, materialize="none")
        assert out.count() == window_dashboard(tables).count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_monthly_run_loads_each_due_month_once(spark):
    from tripmart.plans import monthly_load
    t = fixtures.trips(spark, SMALL).drop("trip_key").filter(
        F.col("year_month").between("1998-01", "1998-04"))
    landing, wh, dash_path = (scratch_path(spark, n) for n in ("t-ml", "t-wh", "t-dash"))
    for m in ["1998-01", "1998-02", "1998-03", "1998-04"]:
        t.filter(F.col("year_month") == m).drop("year_month").write.parquet(
            f"{landing}/yellow_tripdata_{m}.parquet")
    zones_csv = scratch_path(spark, "t-zones")
    fixtures.zones(spark, SMALL).write.option("header", True).csv(zones_csv)
    first = monthly_load.run(spark, landing, wh, zones_csv, "1998-05-20", 1998,
                             dashboard_path=dash_path)
    assert first == ["1998-01", "1998-02", "1998-03"]
    assert monthly_load.run(spark, landing, wh, zones_csv, "1998-05-20", 1998) == []
    assert monthly_load.run(spark, landing, wh, zones_csv, "1998-06-20", 1998) == ["1998-04"]
    counts = {r.year_month: r.n for r in monthly_load.month_counts(spark, wh).collect()}
    want = {r.year_month: r["count"] for r in t.groupBy("year_month").count().collect()}
    assert counts == want
    assert spark.read.parquet(dash_path).count() > 0


def test_streaming_ingest_of_monthly_files(spark):
    from tripmart.streaming.ingest import ingest_available
    t = fixtures.trips(spark, SMALL).drop("trip_key").filter(
        F.col("year_month").between("1998-01", "1998-03"))
    landing, wh, ckpt = (scratch_path(spark, n) for n in ("t-mf", "t-mfwh", "t-mfck"))
    for m in ["1998-01", "1998-02", "1998-03"]:
        t.filter(F.col("year_month") == m).drop("year_month").write.parquet(
            f"{landing}/yellow_tripdata_{m}.parquet")
    args = (landing, wh, ckpt, fixtures.zones(spark, SMALL), static_dims(spark))
    for _ in range(2):
        ingest_available(spark, f"{landing}/yellow_tripdata_*/*.parquet", *args, layout="files")
    counts = {r.year_month: r["count"] for r in
              warehouse.read_table(spark, wh, "fact_trips").groupBy("year_month").count().collect()}
    assert counts == {r.year_month: r["count"] for r in t.groupBy("year_month").count().collect()}


def test_streaming_ingest_loads_a_month_once_however_many_batches(spark, monkeypatch):
    from tripmart.streaming import ingest
    loads, load = [], ingest.load_trips
    monkeypatch.setattr(ingest, "load_trips", lambda *a: (loads.append(a[-1]), load(*a)))
    t = fixtures.trips(spark, SMALL).drop("trip_key").filter(
        F.col("year_month").between("1998-01", "1998-02"))
    landing, wh, ckpt = (scratch_path(spark, n) for n in ("t-once", "t-oncewh", "t-onceck"))
    for _ in range(2):
        t.coalesce(1).write.mode("append").partitionBy("year_month").parquet(landing)
    args = (f"{landing}/year_month=*/*.parquet", landing, wh, ckpt, fixtures.zones(spark, SMALL),
            static_dims(spark))
    ingest.ingest_available(spark, *args, max_files_per_trigger=1)  # four batches, two months
    assert sorted(loads) == [["1998-01"], ["1998-02"]]
    assert warehouse.read_table(spark, wh, "fact_trips").count() == 2 * t.count()
    t.filter("year_month = '1998-02'").coalesce(1).write.mode("append").partitionBy(
        "year_month").parquet(landing)  # a later file: its month is loaded again
    ingest.ingest_available(spark, *args, max_files_per_trigger=1)
    assert sorted(loads) == [["1998-01"], ["1998-02"], ["1998-02"]]
    assert warehouse.read_table(spark, wh, "fact_trips").filter("year_month = '1998-02'").count() == \
        3 * t.filter("year_month = '1998-02'").count()


def _landed(spark, months, spoil=None):
    t = fixtures.trips(spark, SMALL).drop("trip_key").filter(F.col("year_month").isin(months))
    t = spoil(t) if spoil else t
    root = scratch_path(spark, "t-land")
    t.write.partitionBy("year_month").parquet(root)
    zones_csv = scratch_path(spark, "t-zones")
    fixtures.zones(spark, SMALL).write.option("header", True).csv(zones_csv)
    return t, root, zones_csv


def test_rejects_are_kept_and_counted(spark):
    from tripmart.plans import monthly_load
    bad = (F.col("PULocationID") % 7) == 0
    t, landing, zones = _landed(spark, ["1998-01", "1998-02"], lambda d: d.withColumn(
        "tpep_pickup_datetime", F.when(~bad, F.col("tpep_pickup_datetime"))))
    wh = scratch_path(spark, "t-wh")
    due = monthly_load.run(spark, landing, wh, zones, "1998-05-20", 1998, layout="partitioned")
    assert due == ["1998-01", "1998-02"]
    rejects = spark.read.parquet(f"{wh}/rejects")
    n_bad = t.filter(F.col("tpep_pickup_datetime").isNull()).count()
    assert rejects.count() == n_bad > 0
    assert {r.reject_reason for r in rejects.collect()} == {"no pickup time"}
    assert warehouse.read_table(spark, wh, "fact_trips").count() == t.count() - n_bad
    log = {r.year_month: r for r in warehouse.read_log(spark, wh).collect()}
    assert all(r.state == "loaded" and r.n_rows == r.n_facts + r.n_rejects for r in log.values())


def test_stream_keeps_rejects_too(spark):
    from tripmart.streaming.ingest import ingest_available
    bad = (F.col("PULocationID") % 5) == 0
    t, landing, _ = _landed(spark, ["1998-01"], lambda d: d.withColumn(
        "tpep_dropoff_datetime", F.when(~bad, F.col("tpep_dropoff_datetime"))))
    wh = scratch_path(spark, "t-swh")
    ingest_available(spark, f"{landing}/year_month=*/*.parquet", landing, wh,
                     scratch_path(spark, "t-sck"), fixtures.zones(spark, SMALL), static_dims(spark))
    assert spark.read.parquet(f"{wh}/rejects").count() == t.filter(bad).count() > 0


def test_broken_key_fails_the_load(spark):
    import pytest
    from tripmart.plans.load import LoadError, load_trips
    t, landing, _ = _landed(spark, ["1998-01"])
    zones = fixtures.zones(spark, SMALL)
    wh = scratch_path(spark, "t-bad")
    trips = t.filter("year_month = '1998-01'")
    with pytest.raises(LoadError, match="location_dim"):
        load_trips(spark, trips, zones.unionByName(zones), static_dims(spark), wh, ["1998-01"])
    assert warehouse.read_log(spark, wh).first().state == "loading"


def test_torn_reload_is_due_again(spark, monkeypatch):
    import pytest
    from tripmart.plans import monthly_load
    _, landing, zones = _landed(spark, ["1998-01", "1998-02"])
    wh = scratch_path(spark, "t-torn")
    args = (spark, landing, wh, zones)
    monthly_load.run(*args, "1998-05-20", 1998, layout="partitioned")
    assert monthly_load.pending(spark, landing, wh, "1998-05-20", 1998, layout="partitioned") == []
    whole = warehouse.load_monthly

    def fails(df, root, table, mode="replace"):
        if table == "fact_trips":
            raise OSError("disk gone")
        whole(df, root, table, mode)

    monkeypatch.setattr(warehouse, "load_monthly", fails)
    with pytest.raises(OSError):
        monthly_load.load_months(*args, ["1998-02"], layout="partitioned")
    monkeypatch.setattr(warehouse, "load_monthly", whole)
    assert monthly_load.run(*args, "1998-05-20", 1998, layout="partitioned") == ["1998-02"]


def test_undersized_due_month_fails_the_run(spark):
    import os

    import pytest
    from tripmart.plans import monthly_load
    from tripmart.session import local_path
    _, landing, zones = _landed(spark, ["1998-01"])
    os.makedirs(local_path(f"{landing}/year_month=1998-02"))
    with open(local_path(f"{landing}/year_month=1998-02/p.parquet"), "wb") as fh:
        fh.write(b"x" * 498)
    with pytest.raises(ValueError, match="1998-02"):
        monthly_load.pending(spark, landing, scratch_path(spark, "t-none"), "1998-05-20", 1998,
                             layout="partitioned")


def test_few_files_per_month(spark):
    tables = build_star(fixtures.trips(spark, SMALL), fixtures.zones(spark, SMALL),
                        static_dims(spark))
    root = scratch_path(spark, "t-few")
    warehouse.load_monthly(tables["fact_trips"].repartition(12), root, "fact_trips")
    per_month = spark.read.parquet(f"{root}/fact_trips").select(
        "year_month", F.input_file_name().alias("f")).distinct().groupBy("year_month").count()
    assert per_month.agg(F.max("count")).first()[0] == 1


def test_dashboard_leaves_no_cached_frames(spark):
    from tripmart.operators import dashboard as dash
    tables = build_star(fixtures.trips(spark, SMALL), fixtures.zones(spark, SMALL),
                        static_dims(spark))
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    for _ in range(2):
        dash.dashboard(tables).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= before
