"""Score requests arriving as files, continuously or as availableNow runs.

Stateless: each micro-batch is scored with the same fitted models as the
batch path (``operators.scoring.score``) and appended to a Parquet sink; the
checkpoint makes the sink exactly-once across restarts.

``score_lines`` is the stream for a service: a line that is no request goes to a
rejects sink with its raw text, and every micro-batch is scored with the newest
whole version of the models (``sources.model_store``), so a model saved while the
stream runs is used from the next batch on.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.scoring import score
from ..sources.model_store import load_models, newest_version

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType(), True),
    T.StructField("model", T.StringType(), True),
    T.StructField("features", T.ArrayType(T.StringType()), True),
])


def score_stream(spark: SparkSession, source: str, models: dict[str, Transformer],
                 sink: str, checkpoint: str, fmt: str = "json",
                 available_now: bool = True) -> StreamingQuery:
    """Start the scoring stream; with ``available_now`` it stops when caught up."""
    requests = spark.readStream.schema(REQUEST_SCHEMA).format(fmt).load(source)
    writer = (score(requests, models).writeStream.format("parquet")
              .option("path", sink).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


CORRUPT = "_corrupt"
_PARSED = T.StructType([*REQUEST_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])


def parsed_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests, rejects) of a frame of JSON lines (``value``); rejects keep the raw
    line. Blank lines are neither."""
    found = F.from_json("value", _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.filter(F.length(F.trim("value")) > 0).select("value", found.alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    return (rows.filter(~bad).select(*[f"r.{f.name}" for f in REQUEST_SCHEMA.fields]),
            rows.filter(bad).select(F.col("value").alias("raw")))


def score_lines(spark: SparkSession, source: str, model_root: str, sink: str, rejects: str,
                checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Score JSON lines that arrive as files below ``source``.

    Results go to ``sink/batch_id=<n>`` with the ``model_version`` they were scored
    by, lines that do not parse to ``rejects/batch_id=<n>``. A batch that runs again
    after a failure replaces its own folders, so no row is kept twice."""
    held: dict[int, dict[str, Transformer]] = {}

    def run(batch: DataFrame, batch_id: int) -> None:
        version = newest_version(spark, model_root)
        if version not in held:
            held.clear()
            held[version] = load_models(spark, model_root, version)
        requests, bad = parsed_lines(batch)
        score(requests, held[version]).withColumn("model_version", F.lit(version)).write.mode(
            "overwrite").parquet(f"{sink}/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")

    writer = (spark.readStream.format("text").load(source).writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
