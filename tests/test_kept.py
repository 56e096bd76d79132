"""Frames with several readers are joined from the driver's tables once."""

import re
import time

from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.functions.text import WORD_GAPS, words
from tripmart.plans import registry

from conftest import SMALL


def _reads_lineitem(df):
    return any("lineitem" in f for f in df.inputFiles())


def test_tables_made_from_trips_do_not_join_them_again(spark):
    star = registry.star(spark, SMALL)
    assert not _reads_lineitem(star["fact_trips"])
    for name, table in fixtures.coordinate_star(spark, SMALL).items():
        assert not _reads_lineitem(table), name
    assert not _reads_lineitem(registry._described(spark, SMALL))
    assert not _reads_lineitem(registry.requests_from_trips(spark, SMALL))


def test_kept_rows_are_the_same_rows(spark):
    trips = fixtures.trips(spark, SMALL)
    kept = fixtures.kept(trips)
    assert kept.dtypes == trips.dtypes
    assert kept.exceptAll(trips).isEmpty() and trips.exceptAll(kept).isEmpty()


def test_static_dims_are_counted_in_one_pass(spark):
    plan = registry.QUERIES["s3_static_dims"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2  # this one, and the offsets of the calendar keys


def test_words_split_at_every_gap(spark):
    texts = ["Trip Distance: 2.50 miles. Hour: 7.", "-73.9,40.5;a.b. c", "  x\ty\nz.", "..", ".", "", "Ünder é.",
             "a. b .c. ", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", words("t").alias("w")).collect()
    for r in got:
        want = [w for w in re.split(WORD_GAPS, (r.t or "").lower(), flags=re.ASCII) if w]
        assert r.w == want, r.t


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_[^,)]+", disk.getAllBlocks().mkString(",")))


def test_shuffles_go_when_a_write_ends(spark):
    from tripmart import session
    before = _shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert session.kept(rows).count() == 7
    with session.shuffles_released(spark):
        with session.shuffles_released(spark):
            pass
        rows.write.format("noop").mode("overwrite").save()
    assert spark.conf.get(session._RELEASE) == "false"  # as it was
    ends = time.time() + 20
    while (left := {f for f in _shuffle_files(spark) - before if f.endswith(("data", "index"))}) and time.time() < ends:
        time.sleep(0.2)  # removed in the background; of the count a shuffle may stay
    assert len({f.split("_")[1] for f in left}) <= 1, left


def test_trips_of_the_star_are_kept_without_their_key(spark):
    scans = registry.star(spark, SMALL)["fact_trips"]._jdf.queryExecution().analyzed().toString()
    assert "trip_key" not in scans


def test_outcomes_carry_no_second_copy_of_a_row(spark):
    from tripmart.plans import published_load
    from tripmart.schemas import DATETIME_DIM, FACT_COLUMNS
    trips = registry.kept_trips(spark, SMALL, *registry.RAW_COLS, "year_month").limit(20)
    rows = published_load.outcome_rows(trips, spark.createDataFrame([], DATETIME_DIM))
    assert len(rows.columns) == len(FACT_COLUMNS) + 6
    want = {c: trips.filter(F.col(c).isNull()).count() for c in published_load.RAW_FACT_COLUMNS}
    assert any(want.values()) and want == {c: rows.filter(F.col(published_load.MISSING).bitwiseAND(
        F.lit(1 << k)) != 0).count() for k, c in enumerate(published_load.RAW_FACT_COLUMNS)}


def test_no_words_are_written_for_an_embedding(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    from tripmart.operators import embedding
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a: 1 / 0)
    df = spark.createDataFrame([("a b c",), ("a c",)], "text string")
    assert set(embedding.fit_text_vectors(df, "text", dim=2, iterations=1).words) == {"a", "b", "c"}
