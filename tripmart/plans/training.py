"""The training job: trips with durations and demand counts from a star,
sentences, two boosted-tree regressors, their error against the mean
predictor, and model files; plus the scoring side that reuses them."""

from __future__ import annotations

from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_sample, hash_split
from ..functions.text import describe_demand, describe_trip
from ..operators import demand as dem
from ..operators.joins import DEFAULT_MAX_BROADCAST_ROWS, left_lookups
from ..operators.embedding import fit_text_vectors
from ..operators.ml import equal_texts, fit, fit_vectors, mae, predict, predict_vectors, save_model, side_by_side
from ..session import kept


def trips_for_training(star_b: dict[str, DataFrame]) -> DataFrame:
    """J4 + D10 + F2: all facts with all look-ups and durations."""
    joined = left_lookups(star_b["fact_table"], [
        (star_b["datetime_dim"], "datetime_id", ""),
        (star_b["pickup_location_dim"], "pickup_location_id", "_pickup"),
        (star_b["dropoff_location_dim"], "dropoff_location_id", "_dropoff"),
        (star_b["trip_distance_dim"], "trip_distance_id", ""),
        (star_b["passenger_count_dim"], "passenger_count_id", ""),
    ], broadcast_max_rows=DEFAULT_MAX_BROADCAST_ROWS)
    return dem.with_duration(joined)


# What examples take from a trip with its look-ups, without and with places.
EXAMPLE_COLUMNS = ["trip_key", "pickup_location_id", "trip_distance", "passenger_count", "trip_duration",
                   "pickup_hour", "pickup_weekday", "pickup_date"]
PLACE_COLUMNS = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]


def examples(star_b: dict[str, DataFrame], places: bool = False) -> dict[str, DataFrame]:
    """(row_key, input_text, label) for the demand and the duration model, from
    all trips (demand counts are of the whole table), which are joined once for both.

    ``places`` adds the date to the demand sentences and both ends of the trip
    to the duration sentences. Scoring requests have four features and the
    short sentences, so models that serve them are fitted without.
    """
    trips = kept(trips_for_training(star_b), *EXAMPLE_COLUMNS, *(PLACE_COLUMNS if places else []))
    ends = {"pickup": ("pickup_latitude", "pickup_longitude"),
            "dropoff": ("dropoff_latitude", "dropoff_longitude")} if places else {}
    duration = trips.select(
        F.col("trip_key").alias("row_key"),
        describe_trip("trip_distance", "pickup_hour", "pickup_weekday",
                      "passenger_count", **ends).alias("input_text"),
        F.col("trip_duration").alias("label"))
    counts = dem.demand_with_location(dem.demand(trips), star_b["pickup_location_dim"])
    demand = counts.select(
        F.concat_ws("|", "pickup_location_id", "pickup_hour", "pickup_date").alias("row_key"),
        describe_demand("pickup_latitude", "pickup_longitude", "pickup_hour", "pickup_weekday",
                        **({"date": "pickup_date"} if places else {})).alias("input_text"),
        F.col("trip_count").cast("double").alias("label"))
    return {"demand": demand, "duration": duration}


def train(star_b: dict[str, DataFrame], trees: int = 100, rate: float = 0.1, seed: int = 42,
          test_fraction: float = 0.2, fit_fraction: float = 1.0, places: bool = False,
          model_root: str | None = None) -> tuple[dict[str, PipelineModel], DataFrame]:
    """X3-X5 + A5 (+ S13): fit both models; report (model, n, mae,
    mean_predictor_mae) on the held-out part; optionally save the models.

    ``fit_fraction`` (F3) bounds the training rows a model is fitted on; counts,
    labels, the split and the report always cover all rows. The examples are
    kept, and the two-row report is made before this returns.
    """
    spark = star_b["fact_table"].sparkSession
    report = []
    # kept: read by split, fit, mean, scoring
    parts = {name: hash_split(kept(ex), "row_key", test_fraction, seed)
             for name, ex in examples(star_b, places).items()}
    models = side_by_side(spark, {name: partial(
        fit, equal_texts(hash_sample(train_part, "row_key", fit_fraction, seed + 1), "input_text", "label"),
        "input_text", "label", "weight", trees=trees, rate=rate, seed=seed) for name, (train_part, _) in parts.items()})
    for name, (train_part, test_part) in parts.items():
        if model_root:
            save_model(models[name], f"{model_root.rstrip('/')}/{name}")
        mean = train_part.agg(F.avg("label")).first()[0]
        base = mae(test_part.withColumn("prediction", F.lit(mean)), "label").first()
        own = mae(predict(models[name], test_part), "label").first()
        report.append((name, own["n"], own["mae"], base["mae"]))
    return models, spark.createDataFrame(
        report, "model string, n bigint, mae double, mean_predictor_mae double")


def compare_embeddings(rows: DataFrame, fit_fraction: float, trees: int = 20,
                       seed: int = 42) -> DataFrame:
    """X2 held against X2: (n, hashed_mae, learned_mae, mean_mae) over the held-out rows.

    The learned embedding reads all texts and no label; both regressors get the same
    labelled rows, ``fit_fraction`` of the training part.
    """
    rows = kept(rows)
    train_part, test_part = hash_split(rows, "row_key", 0.2, seed)
    some = kept(hash_sample(train_part, "row_key", fit_fraction, seed + 1))
    vectors = fit_text_vectors(rows, "input_text")
    dense = fit_vectors(vectors.transform(some, "input_text", "_vector"), "_vector", "label", trees=trees)
    hashed = fit(some, "input_text", "label", trees=trees)
    mean = some.agg(F.avg("label")).first()[0]
    scored = predict(hashed, test_part).select("input_text", "label", F.col("prediction").alias("_hashed"))
    scored = predict_vectors(dense, vectors.transform(scored, "input_text", "_vector"), "_vector")
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("label") - F.col("_hashed"))).alias("hashed_mae"),
        F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("learned_mae"),
        F.avg(F.abs(F.col("label") - mean)).alias("mean_mae"))
