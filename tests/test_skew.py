"""A third of all rows on one key: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.functions.hashing import key_bucket
from tripmart.operators import dashboard as dash
from tripmart.operators.keys import assign_key
from tripmart.operators.star import build_star
from tripmart.sources.static import static_dims

from conftest import SMALL
from window_plan import window_dashboard

def _skewed_trips(spark):
    HOT = key_bucket("trip_key", 7, 3) == 0  # about one row in three
    t = fixtures.trips(spark, SMALL)
    hot_pickup = F.lit(dt.datetime(1998, 1, 5, 8, 0, 0)).cast("timestamp_ntz")
    return t.select(
        *[c for c in t.columns if c not in
          ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "fare_amount",
           "year_month")],
        F.when(HOT, F.lit("1998-01")).otherwise(F.col("year_month")).alias("year_month"),
        F.when(HOT, hot_pickup).otherwise(F.col("tpep_pickup_datetime"))
        .alias("tpep_pickup_datetime"),
        F.when(HOT, hot_pickup + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                  F.abs(F.hash("trip_key")) % 86400))
        .otherwise(F.col("tpep_dropoff_datetime")).alias("tpep_dropoff_datetime"),
        F.when(HOT, F.lit(1).cast("bigint")).otherwise(F.col("PULocationID")).alias("PULocationID"),
        F.when(HOT, F.lit(10.0)).otherwise(F.col("fare_amount")).alias("fare_amount"))


def test_hot_hour_zone_and_fare(spark):
    tables = build_star(_skewed_trips(spark), fixtures.zones(spark, SMALL), static_dims(spark))
    a = dash.dashboard(tables)
    w = window_dashboard(tables)
    exact = [c for c in dash.DASHBOARD_COLUMNS if not c.startswith("avg")]
    n = a.count()
    assert n == w.count() > 0
    assert a.select(exact).exceptAll(w.select(exact)).count() == 0
    # averages: the two plans add in different orders (last-bit differences)
    for keys, specs in dash.GROUP_METRICS:
        for name, kind, _ in specs:
            if kind != "avg":
                continue
            got = {tuple(r[:-1]): r[-1] for r in a.select(*keys, name).distinct().collect()}
            want = {tuple(r[:-1]): r[-1] for r in w.select(*keys, name).distinct().collect()}
            assert got.keys() == want.keys()
            assert all(abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k])) for k in got)
    hot = a.filter((F.col("pickup_hour") == 8) & (F.col("fare_amount") == 10.0)).count()
    assert hot > n / 5


def test_hot_pickup_time_keeps_dense_keys(spark):
    pairs = _skewed_trips(spark).select("year_month", "tpep_pickup_datetime",
                                        "tpep_dropoff_datetime")
    keyed = assign_key(pairs, ["tpep_pickup_datetime", "tpep_dropoff_datetime"], "k",
                       group_cols=["year_month"], num_partitions=8, distinct=True)
    stats = keyed.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"),
        F.countDistinct("k").alias("d")).collect()
    assert all(s.lo == 0 and s.hi == s.n - 1 and s.d == s.n for s in stats)
    assert max(s.n for s in stats) > keyed.count() / 5


def test_hot_pickup_dropoff_pair_keeps_every_trip(spark):
    # sentinel times shared by a third of the trips: one calendar row, all facts kept
    t = fixtures.trips(spark, SMALL)
    hot = key_bucket("trip_key", 11, 3) == 0
    stamp = F.lit(dt.datetime(1998, 1, 1, 0, 0, 0)).cast("timestamp_ntz")
    t = t.withColumn("year_month", F.when(hot, F.lit("1998-01")).otherwise(F.col("year_month"))) \
        .withColumn("tpep_pickup_datetime",
                    F.when(hot, stamp).otherwise(F.col("tpep_pickup_datetime"))) \
        .withColumn("tpep_dropoff_datetime",
                    F.when(hot, stamp).otherwise(F.col("tpep_dropoff_datetime")))
    tables = build_star(t, fixtures.zones(spark, SMALL), static_dims(spark))
    n_hot = t.filter(hot).count()
    assert tables["fact_trips"].count() == t.count()
    dim = tables["datetime_dim"]
    sentinel = dim.filter((F.col("year_month") == "1998-01")
                          & (F.col("tpep_pickup_datetime") == stamp)
                          & (F.col("tpep_dropoff_datetime") == stamp))
    assert sentinel.count() == 1
    key = sentinel.first().datetime_id
    facts = tables["fact_trips"].filter((F.col("year_month") == "1998-01")
                                        & (F.col("datetime_id") == key)).count()
    assert facts >= n_hot > t.count() / 5
