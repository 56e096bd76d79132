"""Pick up newly landed monthly files and load each month once.

A file-source stream over the landing folder remembers (in its checkpoint)
which files it has seen; ``trigger(availableNow=True)`` processes everything
new and stops, so the job runs as a batch on a schedule and backfills old
months on its first run. Each micro-batch names the months it touched; those
months are re-read whole from the landing folder, turned into star tables
and written with dynamic partition overwrite, so a repeated batch (after a
failure) replaces rather than duplicates. Loads go through ``plans.load``:
rejects are kept and the audits run before a month counts as loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.load import load_trips
from ..schemas import RAW_TRIPS
from ..sources.files import MONTH_IN_PATH, read_trips


def _files(df: DataFrame) -> set[tuple]:
    """(month, path, time written) of the files that the rows of ``df`` come from:
    names, never rows."""
    path = F.col("_metadata.file_path")
    return {tuple(r) for r in df.select(
        F.regexp_extract(path, MONTH_IN_PATH, 1), path,
        F.col("_metadata.file_modification_time")).distinct().collect()}


def month_loader(spark: SparkSession, landing_root: str, warehouse_root: str,
                 zones: DataFrame, static: dict[str, DataFrame], layout: str = "partitioned"):
    """The ``foreachBatch`` function: load every month seen in the batch.

    A month is read whole, so its files that come with later batches are in already: a
    batch that brings no other file of a month does not load it again."""

    read: set[tuple] = set()  # files of the months that this run has loaded

    def load(batch: DataFrame, batch_id: int) -> None:
        months = sorted({month for month, _, _ in _files(batch) - read if month})
        if not months:
            return
        # listed before they are read, so a file that lands meanwhile counts as new
        name = "yellow_tripdata_*" if layout == "files" else "year_month=*"
        landed = _files(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(
            f"{landing_root.rstrip('/')}/{name}"))
        trips = read_trips(spark, landing_root, months, layout=layout)
        load_trips(spark, trips, zones, static, warehouse_root, months)
        read.update(f for f in landed if f[0] in months)

    return load


def ingest_available(spark: SparkSession, landing_glob: str, landing_root: str,
                     warehouse_root: str, checkpoint: str, zones: DataFrame,
                     static: dict[str, DataFrame], layout: str = "partitioned",
                     max_files_per_trigger: int | None = None) -> None:
    """Run one availableNow pass over the landing folder and wait for it."""
    reader = spark.readStream.schema(RAW_TRIPS).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_glob).select(F.col("_metadata"))
    query = (stream.writeStream
             .foreachBatch(month_loader(spark, landing_root, warehouse_root, zones, static, layout))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
