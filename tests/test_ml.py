"""Models, embedding and scoring: batch and stream agree, bad requests are
refused, the training job reports both models."""

from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.session import scratch_path

from conftest import SMALL


def test_scoring_batch_and_stream_agree(spark):
    from tripmart.functions.text import describe_trip
    from tripmart.operators.ml import fit, load_model, save_model
    from tripmart.operators.scoring import score
    from tripmart.plans.registry import requests_from_trips
    from tripmart.streaming.scoring import score_stream
    ex = fixtures.trips(spark, SMALL).select(
        describe_trip("trip_distance", F.hour("tpep_pickup_datetime"),
                      F.weekday("tpep_pickup_datetime"),
                      F.coalesce("passenger_count", F.lit(0.0))).alias("input_text"),
        F.col("trip_distance").alias("label"))
    model = fit(ex, "input_text", "label", trees=2)
    path = scratch_path(spark, "t-model")
    save_model(model, path)
    models = {"duration": load_model(path), "demand": model}
    reqs = requests_from_trips(spark, SMALL)
    batch = score(reqs, models)
    assert batch.count() == reqs.count()
    refused = batch.filter(F.col("error").isNotNull())
    assert refused.filter(F.col("prediction").isNotNull()).count() == 0
    assert refused.count() == reqs.filter(~F.col("model").isin("demand", "duration")).count()
    src, sink = scratch_path(spark, "t-req"), scratch_path(spark, "t-out")
    reqs.write.json(src)
    score_stream(spark, src, models, sink, scratch_path(spark, "t-ck")).awaitTermination()
    streamed = spark.read.parquet(sink)
    cols = ["request_id", "model", "prediction", "error"]
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert streamed.count() == batch.count()


def test_training_job_reports_both_models(spark):
    from tripmart.plans import training
    models, report = training.train(fixtures.coordinate_star(spark, SMALL), trees=3,
                                    model_root=scratch_path(spark, "t-models"))
    rows = {r.model: r for r in report.collect()}
    assert set(rows) == {"demand", "duration"} and set(models) == {"demand", "duration"}
    # the test tables' durations and counts do not depend on the features, so a model
    # cannot do better than the mean here; it must not do much worse either
    assert all(r.n > 0 and r.mae < 1.1 * r.mean_predictor_mae for r in rows.values()), rows
    whole = training.examples(fixtures.coordinate_star(spark, SMALL))
    trips = fixtures.trips(spark, SMALL).filter("tpep_dropoff_datetime > tpep_pickup_datetime")
    assert whole["duration"].count() >= trips.count()  # no sample before the fit
    long = training.examples(fixtures.coordinate_star(spark, SMALL), places=True)
    assert " Pickup: " in long["duration"].first().input_text
    assert " Date: " in long["demand"].first().input_text


def test_embedding_default_and_user_encoder(spark):
    import pandas as pd
    from pyspark.ml.functions import vector_to_array
    from tripmart.operators.ml import embed
    df = spark.createDataFrame([("a", "Trip Distance: 2.50 miles. Hour: 7."), ("b", None)],
                               "k string, text string")
    hashed = embed(df, "text").select("k", vector_to_array("features").alias("v")).collect()
    assert {r.k: sum(1 for x in r.v if x) for r in hashed} == {"a": 6, "b": 0}

    def encoder(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"len": texts.fillna("").str.len(), "one": 1.0})

    enc = embed(df, "text", encoder=encoder, dim=2).collect()
    assert {r.k: list(r.features) for r in enc} == {"a": [35.0, 1.0], "b": [0.0, 1.0]}


def test_malformed_requests_are_refused_not_fatal(spark):
    from tripmart.operators.scoring import INVALID_FEATURES, UNKNOWN_MODEL, score, validate
    reqs = spark.createDataFrame(
        [("1", "duration", ["2.5", "7", "1", "2"]), ("2", "duration", ["x", "7", "1", "2"]),
         ("3", "demand", ["40.7", "-73.9", "8"]), ("4", "forecast", ["1", "2", "3", "4"]),
         ("5", None, None)],
        "request_id string, model string, features array<string>")
    ok, bad = validate(reqs)
    assert [r.request_id for r in ok.collect()] == ["1"]
    reasons = {r.request_id: r.error for r in bad.collect()}
    assert reasons == {"2": INVALID_FEATURES, "3": INVALID_FEATURES, "4": UNKNOWN_MODEL,
                       "5": UNKNOWN_MODEL}
    scored = score(reqs, {})
    assert scored.count() == 5  # no model given: no prediction, and no row lost
    assert scored._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_learned_embedding(spark):
    import numpy as np
    from tripmart.operators.embedding import TextVectors, fit_text_vectors
    # two kinds of texts that share one word; words of a kind never all stand together
    rng = np.random.default_rng(5)
    kinds = (["red", "blue", "green", "pink", "grey", "black"], ["one", "two", "three", "four", "five", "six"])
    rows = [(k, " ".join(["the", *rng.choice(kinds[k], 4)])) for k in range(2) for _ in range(1000)]
    rows += [(None, None), (None, ""), (None, "?! --"), (None, "unheard of"), (0, "red " * 40000)]
    df = spark.createDataFrame(rows, "kind int, text string")
    model = fit_text_vectors(df.filter("kind IS NOT NULL AND length(text) < 100"), "text", dim=8, iterations=10)
    assert set(model.words) == {"the", *kinds[0], *kinds[1]}
    got = model.transform(df, "text", "v").collect()
    by_kind = [np.array([r.v for r in got if r.kind == k][:1000]) for k in range(2)]
    centres = [v.mean(axis=0) for v in by_kind]
    for k in range(2):  # a text is nearer to its own kind
        near = np.linalg.norm(by_kind[k] - centres[k], axis=1) < np.linalg.norm(by_kind[k] - centres[1 - k], axis=1)
        assert near.mean() > 0.95
    assert all(not any(r.v) for r in got if r.kind is None)

    path = scratch_path(spark, "t-vectors")
    model.save(spark, path)
    again = TextVectors.load(spark, path).transform(df, "text", "v").collect()
    assert all(np.allclose(a.v, b.v) for a, b in zip(got, again))

    # the bound on words holds, by count
    few = fit_text_vectors(df, "text", dim=4, vocabulary=3)
    assert 1 <= len(few.words) <= 3 and "the" in few.words
    for nothing in (df.limit(0), df.filter("text = ''")):
        none = fit_text_vectors(nothing, "text", dim=4)
        assert none.words == [] and none.dim == 4
        assert list(none.transform(df.limit(1), "text", "v").first().v) == [0.0] * 4


def test_fit_leaves_out_constant_features_and_grows_the_same_trees(spark):
    from tripmart.operators import ml
    df = spark.range(400).select(
        F.concat_ws(" ", F.lit("all"), F.concat(F.lit("w"), (F.col("id") % 7).cast("string")),
                    F.concat(F.lit("v"), (F.col("id") % 5).cast("string"))).alias("text"),
        ((F.col("id") % 7) * 3 + (F.col("id") % 5)).cast("double").alias("label"))
    model = ml.fit(df, "text", "label", trees=4)
    assert model.stages[-1].numFeatures <= 12  # words that not all texts have
    plain = ml.regressor_pipeline("text", "label", trees=4, select=False).fit(df)
    a, b = (sorted((r.text, r.prediction) for r in ml.predict(m, df).collect()) for m in (model, plain))
    assert a == b and ml.predict(model, df).columns == ["text", "label", "prediction"]
    # no feature varies (texts differ in case only): one leaf, the mean
    alike = spark.createDataFrame([("One", 1.0), ("one", 3.0)], "text string, label double")
    assert [r.prediction for r in ml.predict(ml.fit(alike, "text", "label", trees=2), alike).collect()] == [2.0, 2.0]


def test_fits_run_side_by_side(spark):
    import threading
    from tripmart.operators.ml import side_by_side
    both = threading.Barrier(2, timeout=20)  # breaks if one waits for the other
    assert side_by_side(spark, {"a": lambda: (both.wait(), 1)[1], "b": lambda: (both.wait(), 2)[1]}) == {"a": 1, "b": 2}


def test_embedding_is_trained_in_parts_that_do_not_grow(spark, monkeypatch):
    from tripmart.operators import embedding
    seen, word2vec = [], embedding.Word2Vec
    monkeypatch.setattr(embedding, "PART_WORDS", 100)
    monkeypatch.setattr(embedding, "Word2Vec", lambda **k: (seen.append(k["numPartitions"]), word2vec(**k))[1])
    df = spark.range(90).select(F.concat_ws(" ", F.lit("a b"), F.concat(F.lit("w"), (F.col("id") % 9).cast(
        "string"))).alias("text"))
    vectors = embedding.fit_text_vectors(df, "text", dim=4, iterations=1)
    assert seen == [3] and len(vectors.words) == 11  # 270 words
    # many texts looked up together, in small steps, are what each is alone
    monkeypatch.setattr(embedding, "CHUNK", 2)
    texts = ["a b w1", "", "w1 nothing w1 w2 w2", None, "nothing"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    index = {w: v for w, v in zip(vectors.words, vectors.weighted)}
    for row in vectors.transform(frame, "text", "v").collect():
        found = [index[w] for w in (row.text or "").split() if w in index]
        want = sum(found) / len(found) if found else 0 * vectors.common
        assert abs(row.v - (want - vectors.common * (want @ vectors.common))).max() < 1e-12


def _texts(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("row_key"),
        F.concat_ws(" ", F.concat(F.lit("w"), (F.col("id") % 7).cast("string")),
                    F.concat(F.lit("v"), (F.col("id") % 5).cast("string")), F.lit("3"),
                    F.when(F.col("id") % 3 == 0, "3").otherwise("u")).alias("input_text"),
        ((F.col("id") % 7) * 3 + F.col("id") % 5 + F.col("id") % 11 * 0.3).alias("label"))


def test_equal_texts_grow_the_trees_of_all_rows(spark):
    from tripmart.operators import ml
    df = _texts(spark, 2000)
    merged = ml.equal_texts(df, "input_text", "label")
    assert merged.count() == 7 * 5 * 2 and merged.agg(F.sum("weight")).first()[0] == 2000
    own, all_rows = (ml.fit(x, "input_text", "label", *w, trees=8) for x, w in ((merged, ["weight"]), (df, [])))
    texts = df.select("input_text").distinct()
    a, b = ({r.input_text: r.prediction for r in ml.predict(m, texts).collect()} for m in (own, all_rows))
    assert a.keys() == b.keys() and all(abs(a[t] - b[t]) < 1e-9 for t in a)
    odd = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "input_text string, label double")
    labels = {r.input_text: r.label for r in ml.equal_texts(odd, "input_text", "label").collect()}
    assert labels == {"a": None, "b": 2.0}  # a missing label is not passed over


def test_registered_models_are_fitted_on_all_training_rows(spark, monkeypatch):
    from tripmart.functions.hashing import hash_split
    from tripmart.operators import ml
    from tripmart.plans import registry, training
    rows, seen, fit = _texts(spark, 300), [], ml.fit
    monkeypatch.setattr(training, "examples", lambda star: {"demand": rows, "duration": rows})
    monkeypatch.setattr(fixtures, "coordinate_star", lambda spark, d: None)
    monkeypatch.setattr(registry, "_MODELS", {})
    monkeypatch.setattr(registry, "QUERY_TREES", 1)

    def noted(df, *a, **k):
        seen.append(df.agg(F.sum("weight")).first()[0] if "weight" in df.columns else df.count())
        return fit(df, *a, **k)

    monkeypatch.setattr(ml, "fit", noted)
    registry.fitted_models(spark, "/none")
    train, _ = hash_split(rows, "row_key", 0.2, 42)
    assert seen == [train.count()] * 2


def test_model_words_are_those_of_the_tokenizer(spark):
    from pyspark.ml.feature import RegexTokenizer
    from tripmart.functions.text import WORD_GAPS
    from tripmart.operators import ml
    df = spark.createDataFrame([(t,) for t in [
        "Trip Distance: 2.50 miles. Hour: 7.", "-73.9,40.5;A.b. C", "  x\ty\nz.", "..", "", "Ünder É.", "a. B .c.\n"]],
        "my text string".replace("my text", "`my text`"))
    tok = RegexTokenizer(inputCol="my text", outputCol="want", pattern=WORD_GAPS)
    own = ml.regressor_pipeline("my text", "label").getStages()[0]
    for r in tok.transform(own.transform(df)).collect():
        assert r["_tm_words"] == r["want"], r


def test_trips_are_joined_once_for_both_examples(spark):
    from tripmart.plans import training
    for name, rows in training.examples(fixtures.coordinate_star(spark, SMALL)).items():
        assert "trip_distance_id" not in rows._jdf.queryExecution().analyzed().toString(), name
