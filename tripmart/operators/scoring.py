"""Batch scoring of requests by model name.

A request row is (request_id, model, features array<string>). Features are
read by position: demand = latitude, longitude, hour, weekday; duration =
distance, hour, weekday, passengers.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import describe_demand, describe_trip, explain_prediction
from .ml import predict

MODEL_NAMES = ["demand", "duration"]
N_FEATURES = 4
UNKNOWN_MODEL = "No model of that name: choose demand or duration."
INVALID_FEATURES = "Invalid features: expected 4 numbers."


def _feature(i: int):
    return F.element_at(F.col("features"), i + 1).try_cast("double")


def _features_ok():
    ok = F.coalesce(F.size("features") == N_FEATURES, F.lit(False))
    for i in range(N_FEATURES):
        ok = ok & _feature(i).isNotNull()
    return ok


def request_text(model: str):
    """The sentence a model saw in training, built from a request's features."""
    if model == "demand":
        return describe_demand(_feature(0), _feature(1), _feature(2), _feature(3))
    return describe_trip(_feature(0), _feature(1), _feature(2), _feature(3))


def marked(requests: DataFrame) -> DataFrame:
    """the requests with an ``error`` column, NULL for accepted ones.

    A request is refused for an unknown model name, or for features that are
    not exactly four numbers; one bad request never fails the batch.
    """
    model_ok = F.coalesce(F.col("model").isin(MODEL_NAMES), F.lit(False))
    return requests.withColumn("error", F.when(~model_ok, F.lit(UNKNOWN_MODEL)).when(
        ~_features_ok(), F.lit(INVALID_FEATURES)))


def validate(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused) requests; refused ones carry the reason."""
    rows = marked(requests)
    return (rows.filter(F.col("error").isNull()).drop("error"),
            rows.filter(F.col("error").isNotNull()))


def score(requests: DataFrame, models: dict[str, Transformer]) -> DataFrame:
    """(request_id, model, prediction, explanation, error) for every request.

    The requests are read once: each row gets the sentence of its own model
    (an empty one if refused) and passes through the given models one after
    another; its own model's prediction is kept. Refused requests, and those
    whose model is not given, stay in the output without a prediction.
    """
    text, own = F.lit(""), F.lit(None).cast("double")
    for name in MODEL_NAMES:
        mine = F.col("error").isNull() & (F.col("model") == name)
        text = F.when(mine, request_text(name)).otherwise(text)
    out = marked(requests).withColumn("input_text", text)
    for name in MODEL_NAMES:
        if name not in models:
            continue
        out = predict(models[name], out).withColumnRenamed("prediction", f"_tm_{name}")
        mine = F.col("error").isNull() & (F.col("model") == name)
        own = F.when(mine, F.col(f"_tm_{name}").cast("double")).otherwise(own)
    return out.withColumn("prediction", own).select(
        "request_id", "model", "prediction",
        F.when(F.col("prediction").isNotNull(), explain_prediction(
            F.col("model"), F.col("prediction"))).alias("explanation"), "error")
