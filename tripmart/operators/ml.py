"""Embedding (X2), boosted-tree regressors (X4), prediction (X5), calibration
table (X6), mean absolute error (A5) and model files (S13), on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.feature import HashingTF, SQLTransformer, VarianceThresholdSelector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import words, words_sql

NUM_FEATURES = 1 << 10
TASK_ROWS = 1 << 13  # weighted rows that one task of a fit takes


def with_words(df: DataFrame, text_col: str, out: str = "words") -> DataFrame:
    """The whole text's word tokens (no cut), input of the hashed embedding."""
    return df.withColumn(out, words(text_col))


def embed(df: DataFrame, text_col: str, out: str = "features",
          encoder: Callable[[pd.Series], pd.DataFrame] | None = None,
          dim: int | None = None, num_features: int = NUM_FEATURES) -> DataFrame:
    """A dense/sparse vector per text.

    Default: hashed term counts of all word tokens (JVM-side); for an embedding
    learned from the texts see ``operators.embedding``. With
    ``encoder`` (a function from a pandas Series of texts to rows of floats,
    e.g. a sentence encoder loaded once per worker) the texts go through an
    iterator pandas UDF in Arrow batches, and ``out`` is ``array<float>``.
    """
    if encoder is None:
        tf = HashingTF(inputCol="_tm_words", outputCol=out, numFeatures=num_features)
        return tf.transform(with_words(df, text_col, "_tm_words")).drop("_tm_words")
    if dim is None:
        raise ValueError("dim is required with an encoder")

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:  # one Arrow batch at a time
            yield pd.Series(list(encoder(texts).to_numpy(dtype="float32")))

    return df.withColumn(out, _encode(F.col(text_col)))


def regressor_pipeline(text_col: str, label_col: str, trees: int = 100, rate: float = 0.1,
                       seed: int = 42, max_depth: int = 5,
                       num_features: int = NUM_FEATURES, select: bool = True,
                       weight_col: str | None = None) -> Pipeline:
    """Words -> hashed features -> gradient-boosted trees.

    A tree looks at every feature of every row, though one that has the same value in
    all rows cannot split any. Most hashed terms occur in no sentence, so these are
    left out first (``select``); the trees are those grown with them.
    """
    # the words of RegexTokenizer, which compiles its pattern anew for every text
    tok = SQLTransformer(statement=f"SELECT *, {words_sql(f'`{text_col}`')} AS _tm_words FROM __THIS__")
    tf = HashingTF(inputCol="_tm_words", outputCol="_tm_terms" if select else "_tm_features",
                   numFeatures=num_features)
    varying = VarianceThresholdSelector(featuresCol="_tm_terms", outputCol="_tm_features")
    gbt = GBTRegressor(featuresCol="_tm_features", labelCol=label_col,
                       predictionCol="prediction", maxIter=trees, stepSize=rate, seed=seed,
                       maxDepth=max_depth, **({"weightCol": weight_col} if weight_col else {}))
    return Pipeline(stages=[tok, tf, varying, gbt] if select else [tok, tf, gbt])


def equal_texts(df: DataFrame, text_col: str, label_col: str, weight_col: str = "weight") -> DataFrame:
    """One row a text: its mean label, and in ``weight_col`` how many rows have it.

    The trees are those of all rows. A tree sends rows of one text the same way, and with
    squared errors it needs of them only their number and the sum of their labels: what
    is lost, the spread of labels within a text, no split can lessen. A text with a
    missing label has none here, which a fit refuses as it does the row."""
    label = F.col(label_col)
    return df.groupBy(text_col).agg(
        F.when(F.count(label) == F.count(F.lit(1)), F.avg(label)).alias(label_col),
        F.count(F.lit(1)).cast("double").alias(weight_col))


def fit(df: DataFrame, text_col: str, label_col: str, weight_col: str | None = None,
        **params) -> PipelineModel:
    """Fit one regressor on executors; a row counts ``weight_col`` times, if given.

    The examples are kept (memory and disk) for the length of the fit: the
    learner reads them several times before it bins them. Weighted ones are few for the
    tasks they come in, and a fit is a long row of stages: a task takes ``TASK_ROWS``.
    """
    cols = [text_col, label_col, *([weight_col] if weight_col else [])]
    held = kept = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if weight_col:
            kept = held.coalesce(-(-held.count() // TASK_ROWS) or 1)
        *front, trees = regressor_pipeline(text_col, label_col, weight_col=weight_col, **params).getStages()
        front = Pipeline(stages=front).fit(kept)
        if not front.stages[-1].selectedFeatures:  # all texts alike: nothing to split by
            return regressor_pipeline(text_col, label_col, select=False, weight_col=weight_col,
                                      **params).fit(kept)
        return PipelineModel([*front.stages, trees.fit(front.transform(kept))])
    finally:
        held.unpersist()


def side_by_side(spark: SparkSession, fits: dict[str, Callable[[], PipelineModel]]) -> dict[str, PipelineModel]:
    """The results of all ``fits``, run at the same time. A boosted fit is a long row of
    short jobs, a few for each tree, which leave most of a cluster idle."""
    run = inheritable_thread_target(spark)(lambda one: one())
    with ThreadPool(max(len(fits), 1)) as pool:
        return dict(zip(fits, pool.map(run, fits.values())))


def fit_vectors(df: DataFrame, vector_col: str, label_col: str, trees: int = 100, rate: float = 0.1,
                seed: int = 42, max_depth: int = 5) -> PipelineModel:
    """X4 on a column of dense vectors (array<double>), as ``embedding`` makes them."""
    kept = df.select(array_to_vector(vector_col).alias("_tm_features"), label_col).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        gbt = GBTRegressor(featuresCol="_tm_features", labelCol=label_col, maxIter=trees, stepSize=rate,
                           seed=seed, maxDepth=max_depth)
        return Pipeline(stages=[gbt]).fit(kept)
    finally:
        kept.unpersist()


def predict_vectors(model: Transformer, df: DataFrame, vector_col: str) -> DataFrame:
    """X5 for a model of :func:`fit_vectors`."""
    return model.transform(df.withColumn("_tm_features", array_to_vector(vector_col))).drop("_tm_features")


def predict(model: Transformer, df: DataFrame) -> DataFrame:
    """Add ``prediction``; helper columns of the pipeline are dropped."""
    return model.transform(df).drop("_tm_words", "_tm_terms", "_tm_features")


def mae(df: DataFrame, label_col: str, prediction_col: str = "prediction") -> DataFrame:
    """A5: one row (n, mae)."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.avg(F.abs(F.col(label_col) - F.col(prediction_col))).alias("mae"))


def calibration(df: DataFrame, label_col: str, prediction_col: str = "prediction",
                bin_width: float = 1.0) -> DataFrame:
    """Actual vs. predicted as a binned count table (scatter plot data)."""
    return df.groupBy(
        F.floor(F.col(label_col) / bin_width).cast("bigint").alias("actual_bin"),
        F.floor(F.col(prediction_col) / bin_width).cast("bigint").alias("predicted_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted model (replaces an older one at ``path``)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a fitted model."""
    return PipelineModel.load(path)
