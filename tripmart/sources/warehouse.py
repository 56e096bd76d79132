"""Writers and table management of the star.

Tables live as Parquet folders under one root (``root/<table>``). The two
monthly tables are partitioned by ``year_month``; loading a month replaces
exactly that month's partition (dynamic partition overwrite), so a retried
or repeated load leaves the table as after one load. Dimensions are
replaced whole. ``create_tables`` also registers the folders as catalog
tables for SQL users.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DIMENSION_TABLES, MONTHLY_TABLES, TABLES
from ..session import shuffles_released

REJECTS, LOAD_LOG = "rejects", "load_log"
LOADING, LOADED = "loading", "loaded"
LOG_SCHEMA = "year_month string, state string, n_rows bigint, n_facts bigint, n_rejects bigint"


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def load_dim(df: DataFrame, root: str, table: str) -> None:
    """Replace a dimension table."""
    df.write.mode("overwrite").parquet(table_path(root, table))


def load_monthly(df: DataFrame, root: str, table: str, mode: str = "replace") -> None:
    """Write months of a monthly table.

    ``replace`` (default) overwrites only the months present in ``df``;
    ``append`` adds rows as they are, which duplicates a month that is loaded
    twice (kept for parity with append-only warehouses).
    """
    # rows of a month meet in few tasks (AQE splits large months), so a month is
    # written as few files instead of one per task
    writer = df.hint("rebalance", F.col("year_month")).write.partitionBy("year_month")
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    with shuffles_released(df.sparkSession):
        writer.parquet(table_path(root, table))


def write_star(tables: dict[str, DataFrame], root: str, mode: str = "replace") -> None:
    """Write all star tables: dimensions replaced, monthly tables by month.

    The calendar dimension is written before the fact and the fact is built
    from it by the caller, so keys are computed once.
    """
    for name in DIMENSION_TABLES:
        if name in tables:
            load_dim(tables[name], root, name)
    for name in MONTHLY_TABLES:
        if name in tables:
            load_monthly(tables[name], root, name, mode)


def write_rejects(rejects: DataFrame, root: str) -> None:
    """Rows that could not be loaded, by month; a reload replaces its months."""
    load_monthly(rejects, root, REJECTS)


def log_months(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Note (year_month, state, n_rows, n_facts, n_rejects) of months; the last
    state of a month replaces earlier ones."""
    load_monthly(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), root, LOAD_LOG)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The log's rows; empty where nothing was ever logged."""
    try:
        return spark.read.parquet(table_path(root, LOAD_LOG)).withColumn(
            "year_month", F.col("year_month").cast("string"))
    except AnalysisException:  # no load yet
        return spark.createDataFrame([], LOG_SCHEMA)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Read a star table back with its declared column order and types.

    Monthly tables are read with partition discovery (so a month filter
    prunes folders); the partition value is always taken as text.
    """
    if table not in MONTHLY_TABLES:
        df = spark.read.schema(TABLES[table]).parquet(table_path(root, table))
    else:
        df = spark.read.option("basePath", table_path(root, table)) \
            .parquet(table_path(root, table))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in TABLES[table].fields])


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: read_table(spark, root, t) for t in TABLES}


def save_table(df: DataFrame, path: str) -> None:
    """Create or replace a derived table (e.g. the dashboard) as a select."""
    df.write.mode("overwrite").parquet(path)


def create_tables(spark: SparkSession, root: str, database: str = "tripmart") -> list[str]:
    """Declare the six star tables (empty if new) in the catalog.

    Each table is a Parquet table located at ``root/<table>``; monthly tables
    are partitioned by ``year_month``. Returns the qualified names.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root.rstrip('/')}/_catalog'")
    names = []
    for table, schema in TABLES.items():
        cols = [f for f in schema.fields if not (table in MONTHLY_TABLES and f.name == "year_month")]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols)
        if table in MONTHLY_TABLES:
            ddl += ", `year_month` string"
        part = " PARTITIONED BY (year_month)" if table in MONTHLY_TABLES else ""
        name = f"`{database}`.`{table}`"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part} "
                  f"LOCATION '{table_path(root, table)}'")
        names.append(f"{database}.{table}")
    return names


def refresh_tables(spark: SparkSession, database: str = "tripmart") -> None:
    """Make the catalog see partitions and files written by path."""
    for table in TABLES:
        name = f"`{database}`.`{table}`"
        if table in MONTHLY_TABLES:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        spark.sql(f"REFRESH TABLE {name}")


def truncate_tables(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Empty all six tables, keeping their definitions (schemas).

    Each folder is replaced by an empty table of its schema; monthly tables
    drop every partition (static overwrite). Catalog entries, if any, are
    refreshed so that SQL sees the empty tables.
    """
    for table, schema in TABLES.items():
        empty = spark.createDataFrame([], schema)
        writer = empty.write.mode("overwrite")
        if table in MONTHLY_TABLES:
            writer = writer.partitionBy("year_month").option("partitionOverwriteMode", "static")
        writer.parquet(table_path(root, table))
        if database:
            name = f"`{database}`.`{table}`"
            if table in MONTHLY_TABLES:
                spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
            spark.sql(f"REFRESH TABLE {name}")


# --- catalog layout with co-bucketed monthly tables --------------------------

def save_star_tables(tables: dict[str, DataFrame], database: str, buckets: int = 64,
                     location: str | None = None) -> None:
    """S4/S6/S7 into catalog tables, with the calendar join co-located.

    ``fact_trips`` and ``datetime_dim`` are partitioned by ``year_month`` and
    bucketed (and sorted) by ``datetime_id`` into the same number of
    buckets, so the join on (year_month, datetime_id) reads matching buckets
    without a shuffle (the job must allow partial-key co-partitioning:
    ``spark.sql.requireAllClusterKeysForCoPartition=false``; dense ids cannot
    skew). A table is created on first use; afterwards each load replaces
    only its months (dynamic partition overwrite). Dimensions are replaced.
    A new database is placed at ``location`` (default: the session's
    warehouse folder).
    """
    spark = next(iter(tables.values())).sparkSession
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    for name in DIMENSION_TABLES:
        if name in tables:
            tables[name].write.mode("overwrite").saveAsTable(f"`{database}`.`{name}`")
    for name in MONTHLY_TABLES:
        if name not in tables:
            continue
        qualified = f"`{database}`.`{name}`"
        df = tables[name].select(*[f.name for f in TABLES[name].fields])
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
            df.hint("rebalance", F.col("year_month")).write.insertInto(qualified, overwrite=True)
        else:
            (df.hint("rebalance", F.col("year_month")).write.partitionBy("year_month").bucketBy(buckets, "datetime_id")
             .sortBy("datetime_id").saveAsTable(qualified))


def read_catalog_star(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The six star tables from the catalog, in declared column order."""
    return {t: spark.table(f"`{database}`.`{t}`").select(*[f.name for f in TABLES[t].fields])
            for t in TABLES}
