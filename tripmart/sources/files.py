"""Readers: raw monthly trip files (S1), CSV look-ups (S2), landing report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.star import conform
from ..schemas import RAW_TRIPS

# Text tokens that pandas' CSV reader treats as missing by default.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Name of a published raw month file, and the month in a path
# (such a file name, or a ``year_month=`` partition folder).
MONTH_FILE = "yellow_tripdata_{year_month}.parquet"
# Bytes that the files of a month must have together to be taken for one.
MIN_MONTH_BYTES = 1000
MONTH_IN_PATH = r"(?:yellow_tripdata_|year_month=)(\d{4}-\d{2})"


def month_file(root: str, year_month: str) -> str:
    return f"{root.rstrip('/')}/{MONTH_FILE.format(year_month=year_month)}"


def read_trips(spark: SparkSession, root: str, months: Sequence[str] | None = None,
               layout: str = "partitioned") -> DataFrame:
    """Raw trips with ``year_month`` = the month of the file they came from.

    ``layout="partitioned"``: ``root/year_month=YYYY-MM/*.parquet``.
    ``layout="files"``: one ``yellow_tripdata_YYYY-MM.parquet`` per month (a
    file or a folder of parts).

    Monthly files differ in column types, spelling and presence, so every
    month is read with its own schema and conformed to the raw one. Months
    of equal schema are read together: the plan has one scan per schema, not
    per month. A month whose landed files are too small raises (see
    :func:`require_accepted`).
    """
    months = require_accepted(landed_months(spark, root, layout), months)
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for m in months:  # a footer read per month; never rows
        path = month_path(root, m, layout)
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
        by_schema.setdefault(schema.json(), (schema, []))[1].append(path)
    month = F.regexp_extract(F.col("_metadata.file_path"), MONTH_IN_PATH, 1)
    frames = []
    for schema, paths in by_schema.values():
        rows = spark.read.schema(schema).parquet(*paths).withColumn("_tm_month", month)
        frames.append(conform(rows, RAW_TRIPS, keep=[F.col("_tm_month").alias("year_month")]))
    if not frames:
        empty = T.StructType([*RAW_TRIPS.fields, T.StructField("year_month", T.StringType())])
        return spark.createDataFrame([], empty)
    return reduce(lambda a, b: a.unionByName(b), frames)


def month_path(root: str, year_month: str, layout: str) -> str:
    if layout == "files":
        return month_file(root, year_month)
    return f"{root.rstrip('/')}/year_month={year_month}"


def landed_months(spark: SparkSession, root: str, layout: str = "partitioned",
                  min_bytes: int = MIN_MONTH_BYTES) -> DataFrame:
    """(year_month, bytes, files, accepted): one row per landed month.

    A month is accepted by the total of its files, so many small parts are
    as good as one large file.
    """
    if layout not in ("partitioned", "files"):
        raise ValueError(f"unknown layout {layout!r}")
    name = "yellow_tripdata_*" if layout == "files" else "year_month=*"
    return landing_report(spark, f"{root.rstrip('/')}/{name}", min_bytes).groupBy(
        "year_month").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"),
                          F.first("accepted").alias("accepted"))


def require_accepted(landed: DataFrame, months: Sequence[str] | None = None) -> list[str]:
    """The months to read, sorted; raises if one of them is refused or absent."""
    rows = {r.year_month: r for r in landed.collect()}  # one row per month
    wanted = sorted(rows if months is None else months)
    absent = [m for m in wanted if m not in rows]
    if absent:
        raise FileNotFoundError(f"no landed files for {', '.join(absent)}")
    small = [f"{m} ({rows[m].bytes} bytes)" for m in wanted if not rows[m].accepted]
    if small:
        raise ValueError(f"landed months too small to be complete: {', '.join(small)}")
    return wanted


def available_files(spark: SparkSession, root: str) -> list[str]:
    """Months that have a raw file under ``root`` (a listing of file names)."""
    return sorted(r.year_month for r in landed_months(spark, root, "files").collect())


def read_lookup(spark: SparkSession, path: str, schema: T.StructType,
                missing: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """A headed CSV with every missing-value token read as NULL.

    All columns are read as text first (no inference pass), so a token such
    as 'NA' is not parsed differently per column; columns are matched to
    ``schema`` by name (any order, any case) and cast to its types.
    """
    # every column as text; quotes inside a field are doubled, fields may span lines
    raw = spark.read.option("header", True).option("escape", '"').option(
        "multiLine", True).csv(path)
    present = {c.lower(): c for c in raw.columns}
    tokens = list(missing)
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{src}`")
        cols.append(F.when(F.trim(c).isin(tokens), F.lit(None)).otherwise(c)
                    .cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def landing_report(spark: SparkSession, pattern: str,
                   min_bytes: int = MIN_MONTH_BYTES) -> DataFrame:
    """Landed raw files with size, month and whether the month is accepted.

    A month whose files have less than ``min_bytes`` together is refused, as
    a download that small cannot be a month of trips. Only file metadata is
    read: the content column is pruned from the binary-file scan.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(pattern)
    total = F.sum("bytes").over(Window.partitionBy("year_month"))
    return files.select(
        "path", F.col("length").alias("bytes"), "modificationTime",
        F.regexp_extract(F.col("path"), MONTH_IN_PATH, 1).alias("year_month")).withColumn(
        "accepted", total >= min_bytes)
