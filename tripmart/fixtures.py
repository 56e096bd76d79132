"""Trip-shaped test frames derived from the driver's TPC-H-like tables.

``trips`` maps lineitem x orders onto the raw trip layout, ``zones`` maps
nation x region onto the zone lookup. The mapping holds every data case the
pipeline has to handle: missing vendor, passengers and flag, unmatched keys,
zero distance, negative fares and durations, repeated pickup/dropoff pairs,
NULL zone names and all 24 hours. The DuckDB oracles build the same frames
with the same rules (``plans.oracles``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import words
from .session import kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips plus ``trip_key`` (unique row key) and ``year_month``."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    pickup = ("o_orderdate + make_dt_interval(0, cast(l_orderkey % 24 as int), "
              "cast(l_partkey % 60 as int), 0)")
    shift = ("make_dt_interval(0, 0, cast((l_partkey * 7 + l_linenumber * 13) % 95 - 4 as int), "
             "cast(l_orderkey % 60 as int))")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.expr("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)").alias("trip_key"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        F.expr("CASE WHEN l_suppkey % 4 = 3 THEN NULL ELSE l_suppkey % 4 END").alias("VendorID"),
        F.expr(pickup).alias("tpep_pickup_datetime"),
        F.expr(f"{pickup} + {shift}").alias("tpep_dropoff_datetime"),
        F.expr("CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END")
        .alias("passenger_count"),
        F.expr("(l_quantity - 1) / 4").alias("trip_distance"),
        F.expr("CAST(l_suppkey % 30 AS BIGINT)").alias("PULocationID"),
        F.expr("CAST(l_partkey % 27 AS BIGINT)").alias("DOLocationID"),
        F.expr("CAST(l_orderkey % 8 AS BIGINT)").alias("payment_type"),
        F.expr("CAST(l_linenumber AS BIGINT)").alias("RatecodeID"),
        F.expr("CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END")
        .alias("store_and_fwd_flag"),
        F.expr("CASE WHEN l_partkey % 40 = 1 THEN -l_extendedprice ELSE l_extendedprice END")
        .alias("fare_amount"),
        F.col("l_tax").alias("extra"),
        F.lit(0.5).cast("double").alias("mta_tax"),
        (F.col("l_discount") * 100).alias("tip_amount"),
        F.lit(0.0).cast("double").alias("tolls_amount"),
        F.lit(1.0).cast("double").alias("improvement_surcharge"),
        (F.col("l_extendedprice") + F.col("l_tax")).alias("total_amount"),
        F.lit(2.5).cast("double").alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("Airport_fee"),
    )


# What the coordinate star and the sentences take from a trip.
COORDINATE_COLUMNS = ["trip_key", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                      "trip_distance", "PULocationID", "DOLocationID"]


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup (LocationID, Borough, Zone, service_zone), 25 rows."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("LocationID"),
        F.expr("CASE WHEN n_nationkey = 23 THEN NULL ELSE r_name END").alias("Borough"),
        F.expr("CASE WHEN n_nationkey = 22 THEN NULL ELSE n_name END").alias("Zone"),
        F.expr("CASE WHEN n_nationkey % 2 = 0 THEN 'Zone A' ELSE 'Zone B' END")
        .alias("service_zone"),
    )


def signal_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose durations and counts follow from what the sentences say.

    In ``trips`` neither does. Here a trip takes 5 minutes, 4 more a mile and 15
    more between 7 and 10 o'clock, when four times as many trips begin; all
    begin on one day, so demand groups hold many trips."""
    t = trips(spark, sf_dir)
    begin = F.col("tpep_pickup_datetime")
    rush = F.hour(begin).between(7, 9)
    copies = F.explode(F.sequence(F.lit(1), F.when(rush, 4).otherwise(1)))
    minutes = F.lit(5) + 4 * F.col("trip_distance") + F.when(rush, 15).otherwise(0)
    start = F.make_timestamp_ntz(F.lit(2000), F.lit(1), F.lit(1), F.hour(begin), F.minute(begin), F.lit(0))
    return t.withColumn("_copy", copies).withColumns({
        "trip_key": F.concat_ws("-", "trip_key", "_copy"), "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + F.make_dt_interval(mins=F.floor(minutes).cast("int"))}
    ).drop("_copy")


def coordinate_star(spark: SparkSession, sf_dir: str,
                    of: DataFrame | None = None) -> dict[str, DataFrame]:
    """The coordinate-style star the training step reads (model B).

    Keys and dimensions are derived from ``of`` (default ``trips``): locations get made-up
    coordinates from their zone id, distance and passenger values get their
    own small dimensions keyed by the value's rank. Every table is a Spark
    derivation of the driver tables, so its size grows with them. All six read ``of``,
    so it should be ``kept``, as the default is.
    """
    t = kept(trips(spark, sf_dir), *COORDINATE_COLUMNS) if of is None else of
    fact = t.select(
        "trip_key",
        F.col("trip_key").alias("datetime_id"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        F.expr("CAST(round(trip_distance * 4) AS BIGINT)").alias("trip_distance_id"),
        F.expr("CAST(coalesce(passenger_count, 0) AS BIGINT)").alias("passenger_count_id"),
    )
    datetime_dim = t.select(F.col("trip_key").alias("datetime_id"),
                            "tpep_pickup_datetime", "tpep_dropoff_datetime")
    loc_ids = t.select(F.col("PULocationID").alias("id")).union(
        t.select(F.col("DOLocationID").alias("id"))).distinct()

    def loc(prefix: str) -> DataFrame:
        return loc_ids.select(
            F.col("id").alias(f"{prefix}_location_id"),
            (F.lit(40.5) + F.col("id") * 0.01).alias(f"{prefix}_latitude"),
            (F.lit(-74.2) + F.col("id") * 0.01).alias(f"{prefix}_longitude"),
        )

    dist = fact.select("trip_distance_id").distinct().select(
        "trip_distance_id", (F.col("trip_distance_id") / 4.0).alias("trip_distance"))
    pax = fact.select("passenger_count_id").distinct().select(
        "passenger_count_id", F.col("passenger_count_id").cast("double").alias("passenger_count"))
    return {"fact_table": fact, "datetime_dim": datetime_dim,
            "pickup_location_dim": loc("pickup"), "dropoff_location_dim": loc("dropoff"),
            "trip_distance_dim": dist, "passenger_count_dim": pax}


def pieces_with_rates(spark: SparkSession, sf_dir: str, size: int = 8) -> DataFrame:
    """(row_key, input_text, label): every run of ``size`` words of every document (the
    last of a document may be shorter) and a rate that follows from its language.

    No single word decides the label, but words of one language stand together."""
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL AND lang IS NOT NULL")
    w = docs.select("doc_id", "lang", words("text").alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.floor((F.size("w") - 1) / size).cast("int"))
    return w.select("doc_id", "lang", "w", F.explode(starts).alias("piece")).select(
        F.concat_ws("|", "doc_id", "piece").alias("row_key"),
        F.concat_ws(" ", F.slice("w", F.col("piece") * size + 1, size)).alias("input_text"),
        F.expr("CASE lang WHEN 'en' THEN 1.0D WHEN 'de' THEN 2.0D WHEN 'fr' THEN 3.0D ELSE 4.0D END")
        .alias("label"))
