"""Streamed requests: broken lines are kept, saved models are taken up."""

import json

from pyspark.sql import functions as F

from tripmart.operators.ml import fit
from tripmart.session import scratch_path
from tripmart.sources import model_store
from tripmart.streaming.scoring import parsed_lines, score_lines


def small_model(spark, label):
    rows = [(f"Trip Distance: {k}.00 miles. Hour: 7. Weekday: 1. Passengers: 2.", label) for k in range(6)]
    return fit(spark.createDataFrame(rows, "input_text string, label double"), "input_text", "label", trees=1)


def request(key, model="duration"):
    return json.dumps({"request_id": key, "model": model, "features": ["2.0", "7", "1", "2"]})


def test_broken_lines_and_a_new_model_between_batches(spark):
    src, models, sink, bad, ckpt = (scratch_path(spark, f"t-{n}") for n in ("src", "m", "out", "bad", "ck"))

    def arrive(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
            "append").text(src)
        score_lines(spark, src, models, sink, bad, ckpt).awaitTermination()

    broken = '{"request_id": "x", "model": "dur'
    arrive(request("a"), broken, "", "[1, 2]", "plain text")
    assert model_store.save_models(spark, {"duration": small_model(spark, 10.0)}, models) == 1
    arrive(request("b"), request("c", "forecast"))
    assert model_store.save_models(spark, {"duration": small_model(spark, 30.0)}, models) == 2
    arrive(request("d"), broken)
    got = {r.request_id: r for r in spark.read.parquet(sink).collect()}
    assert {k: (r.prediction, r.model_version) for k, r in got.items()} == {
        "a": (None, 0), "b": (10.0, 1), "c": (None, 1), "d": (30.0, 2)}
    assert got["c"].error and not got["b"].error
    raw = sorted(r.raw for r in spark.read.parquet(bad).collect())
    assert raw == sorted([broken, broken, "[1, 2]", "plain text"])


def test_half_a_version_is_not_seen(spark):
    root = scratch_path(spark, "t-models")
    model = small_model(spark, 5.0)
    model_store.save_model(model, f"{root}/m-unfinished/duration")
    assert model_store.newest_version(spark, root) == 0
    assert model_store.load_models(spark, root, 0) == {}
    model_store.save_models(spark, {"duration": model}, root)
    assert list(model_store.load_models(spark, root, 1)) == ["duration"]


def test_lines_that_parse(spark):
    lines = spark.createDataFrame([('{"request_id":"1","model":"demand","features":["1"],"more":2}',),
                                   ("{}",), (" ",), (None,), ('{"request_id":',)], "value string")
    good, bad = parsed_lines(lines)
    assert [r.request_id for r in good.orderBy(F.desc_nulls_last("request_id")).collect()] == ["1", None]
    assert [r.raw for r in bad.collect()] == ['{"request_id":']
