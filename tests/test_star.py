"""Star build: dense keys, row-preserving join, parity join, fills."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.operators import star as S
from tripmart.operators.keys import assign_key
from tripmart.schemas import RAW_TRIPS

from conftest import SMALL


def test_dense_key_is_0_to_n_minus_1_per_group(spark):
    pairs = fixtures.trips(spark, SMALL).select(
        "year_month", "tpep_pickup_datetime", "tpep_dropoff_datetime").distinct()
    for parts in (1, 3, 16):
        keyed = assign_key(pairs, ["tpep_pickup_datetime", "tpep_dropoff_datetime"], "k",
                           group_cols=["year_month"], num_partitions=parts)
        stats = keyed.groupBy("year_month").agg(
            F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"),
            F.countDistinct("k").alias("d")).collect()
        assert all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in stats)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=7))
def test_dense_key_matches_sorted_position(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in sorted(set(values))], "v int")
    keyed = assign_key(df, ["v"], "k", num_partitions=parts).collect()
    expected = {v: i for i, v in enumerate(sorted(set(values)))}
    assert {r.v: r.k for r in keyed} == expected


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_TRIPS).withColumn("year_month", F.lit("2024-02"))


def test_distinct_pairs_keep_one_fact_per_trip(spark):
    t0 = dt.datetime(2024, 2, 1, 9, 0)
    t1 = t0 + dt.timedelta(minutes=7)
    row = (1, t0, t1, 1.0, 1.0, 1, "N", 1, 1, 1, 5.0, 0.0, 0.5, 0.0, 0.0, 1.0, 6.5, 2.5, 0.0)
    raw = _raw(spark, [row, row, row]).withColumn("trip_key", F.monotonically_increasing_id())
    dim = S.datetime_dim(raw)
    assert dim.count() == 1
    assert S.fact_table(raw, dim).count() == 3


def test_fill_missing_handles_nan_and_null(spark):
    t0 = dt.datetime(2024, 2, 1, 9, 0)
    row = (None, t0, t0, float("nan"), None, None, None, None, None, None, None, None, None,
           None, None, None, None, None, None)
    out = S.fill_missing(_raw(spark, [row])).collect()[0]
    assert out.VendorID == 0 and out.passenger_count == 0.0 and out.trip_distance == 0.0
    assert out.store_and_fwd_flag == "N" and out.RatecodeID == 0


def test_rows_without_times_are_rejected(spark):
    t0 = dt.datetime(2024, 2, 1, 9, 0)
    good = (1, t0, t0, 1.0, 1.0, 1, "N", 1, 1, 1, 5.0, 0.0, 0.5, 0.0, 0.0, 1.0, 6.5, 2.5, 0.0)
    bad = (1, None, t0, 1.0, 1.0, 1, "N", 1, 1, 1, 5.0, 0.0, 0.5, 0.0, 0.0, 1.0, 6.5, 2.5, 0.0)
    rows = _raw(spark, [good, bad, good]).withColumn(
        "year_month", F.when(F.monotonically_increasing_id() % 2 == 0, F.col("year_month")))
    ok, rejected = S.split_rejects(_raw(spark, [good, bad]))
    assert ok.count() == 1 and [r.reject_reason for r in rejected.collect()] == ["no pickup time"]
    ok, rejected = S.split_rejects(rows.withColumn("year_month", F.lit(None).cast("string")))
    assert ok.count() == 0 and {r.reject_reason for r in rejected.collect()} == {"no month"}


def test_pairs_are_made_distinct_before_the_range_exchange(spark):
    import re
    t0 = dt.datetime(2024, 2, 1, 9, 0)
    rows = spark.range(30_000).select(F.lit("2024-02").alias("year_month"), F.lit(t0).alias("a"),
                                      F.lit(t0).alias("b")).repartition(4)
    tracker = spark.sparkContext.statusTracker()
    keyed = assign_key(rows, ["a", "b"], "k", group_cols=["year_month"], distinct=True)
    assert keyed.count() == 1 and tracker is not None
    deduped = rows.dropDuplicates().repartitionByRange(4, "year_month", "a", "b")
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    # top down: range exchange, final aggregate, hash exchange, partial aggregate
    order = re.findall(r"rangepartitioning|hashpartitioning|HashAggregate", plan)
    assert order[:4] == ["rangepartitioning", "HashAggregate", "hashpartitioning", "HashAggregate"]


def test_weekday_monday_is_zero(spark):
    from tripmart.functions.calendar import calendar_parts
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 0),)], "t timestamp_ntz")
    r = df.select(*calendar_parts("t", "p")).collect()[0]
    assert r.p_weekday == 0 and r.p_day == 1 and r.p_hour == 5


def test_dense_key_on_cached_input_stays_dense(spark):
    pairs = fixtures.trips(spark, SMALL).select(
        "year_month", "tpep_pickup_datetime", "tpep_dropoff_datetime").distinct().persist()
    n = pairs.count()
    keyed = assign_key(pairs, ["tpep_pickup_datetime", "tpep_dropoff_datetime"], "k",
                       group_cols=["year_month"])
    assert keyed.count() == n
    bad = keyed.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("n"), F.max("k").alias("hi"), F.countDistinct("k").alias("d")
    ).filter("hi != n - 1 OR d != n").count()
    assert bad == 0
    pairs.unpersist()


def test_conform_reads_nan_in_integer_columns_as_missing(spark):
    t0 = dt.datetime(2024, 2, 1, 9, 0)
    df = spark.createDataFrame(
        [(float("nan"), t0, t0, 2.0), (2.0, t0, t0, None)],
        "VendorID double, tpep_pickup_datetime timestamp_ntz, "
        "tpep_dropoff_datetime timestamp_ntz, RatecodeID double")
    out = S.fill_missing(S.conform(df, RAW_TRIPS)).orderBy("VendorID").collect()
    assert [(r.VendorID, r.RatecodeID) for r in out] == [(0, 2), (2, 0)]
    assert out[0].congestion_surcharge == 0.0 and out[0].store_and_fwd_flag == "N"


def test_fill_missing_on_float_typed_integer_columns(spark):
    df = spark.createDataFrame([(float("nan"),), (3.0,), (None,)], "VendorID double")
    assert sorted(r.VendorID for r in S.fill_missing(df).collect()) == [0, 0, 3]
