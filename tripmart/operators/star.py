"""Build the trip star (fact + datetime dimension) from raw trips.

D1/D2/D4 calendar dimension, D3 keys, J1 fact-to-dimension join, D5-D8
fact projection with missing values filled, S5 conform-to-schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.calendar import calendar_parts, parse_timestamp
from .keys import assign_key

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns of ``schema``, in order, cast to its types.

    Columns matched case-insensitively; absent columns become typed NULLs
    (raw months differ in spelling and presence of some columns). Columns in
    ``keep`` are passed through after them.
    """
    present = {c.lower(): c for c in df.columns}
    cols = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        value = F.col(f"`{src}`") if src is not None else F.lit(None)
        if isinstance(field.dataType, T.TimestampNTZType) and src is not None:
            value = parse_timestamp(value)
        elif (isinstance(field.dataType, T.IntegralType) and src is not None
              and isinstance(df.schema[src].dataType, T.FractionalType)):
            # an integer column stored as float marks missing values with NaN
            value = F.when(~F.isnan(value), value)
        cols.append(value.cast(field.dataType).alias(field.name))
    return df.select(*cols, *keep)


def reject_reason() -> Column:
    """Why a row cannot be placed in the calendar; NULL for a good row."""
    return (F.when(F.col("year_month").isNull(), F.lit("no month"))
            .when(F.col(PICKUP).isNull(), F.lit("no pickup time"))
            .when(F.col(DROPOFF).isNull(), F.lit("no dropoff time")))


def split_rejects(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rows with a month and both times, and the others with a
    ``reject_reason``. Every row is in exactly one of the two."""
    marked = trips.withColumn("reject_reason", reject_reason())
    return (marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            marked.filter(F.col("reject_reason").isNotNull()))


def with_load_month(df: DataFrame, year_month: str | None = None) -> DataFrame:
    """Tag rows with the load month; refill NULLs when a month is given."""
    if year_month is None:
        return df
    if "year_month" not in df.columns:
        return df.withColumn("year_month", F.lit(year_month))
    return df.withColumn("year_month", F.coalesce(F.col("year_month"), F.lit(year_month)))


def calendar_columns(df: DataFrame) -> DataFrame:
    """D2 for both trip ends, in the datetime dimension's column order."""
    return df.select(
        "datetime_id", PICKUP, DROPOFF, "year_month",
        *calendar_parts(PICKUP, "pickup"), *calendar_parts(DROPOFF, "dropoff"))


def datetime_dim(trips: DataFrame) -> DataFrame:
    """The calendar dimension, keyed 0..n-1 within each ``year_month``: one row
    per distinct (pickup, dropoff) pair, so the fact join keeps one fact per
    trip."""
    keyed = assign_key(trips.select("year_month", PICKUP, DROPOFF), [PICKUP, DROPOFF],
                       "datetime_id", group_cols=["year_month"], distinct=True)
    return calendar_columns(keyed)


def fill_missing(df: DataFrame) -> DataFrame:
    """Ints -> 0 (bigint), doubles -> 0.0 (also NaN), flag -> 'N'."""
    ints = [c for c in schemas.RAW_INT_COLUMNS if c in df.columns]
    dbls = [c for c in schemas.RAW_DOUBLE_COLUMNS if c in df.columns]
    out = df
    for c in ints:
        col = F.col(c)
        if isinstance(df.schema[c].dataType, T.FractionalType):
            col = F.when(~F.isnan(col), col)  # NaN is a missing value, like NULL
        out = out.withColumn(c, col.cast("bigint"))
    for c in dbls:
        out = out.withColumn(c, F.col(c).cast("double"))
    out = out.na.fill(0, ints).na.fill(0.0, dbls)
    if "store_and_fwd_flag" in df.columns:
        out = out.withColumn("store_and_fwd_flag", F.col("store_and_fwd_flag").cast("string"))
        out = out.na.fill("N", ["store_and_fwd_flag"])
    return out


def fact_table(trips: DataFrame, dt_dim: DataFrame) -> DataFrame:
    """J1 + D5-D8: trips joined to their calendar row, 18 fact columns + month.

    The join is on (year_month, pickup, dropoff), with the dimension pruned to
    those columns and its key. The dimension has distinct pairs, so there is
    one fact per trip.
    """
    keys = dt_dim.select("year_month", PICKUP, DROPOFF, "datetime_id")
    joined = trips.join(keys, on=["year_month", PICKUP, DROPOFF], how="inner")
    return fill_missing(joined.select(*schemas.FACT_COLUMNS, "year_month"))


def build_star(trips: DataFrame, zones: DataFrame, static: dict[str, DataFrame],
               year_month: str | None = None) -> dict[str, DataFrame]:
    """All six star tables for the given raw trips (one or many months).

    Rows without a month or a timestamp are left out here; :func:`split_rejects`
    returns them, and the load jobs write them. The calendar keys come from a checkpoint
    (:func:`assign_key`), so the dimension that is written and the one the
    facts are joined to carry the same keys, even if executors are lost in
    between.
    """
    good, _ = split_rejects(with_load_month(trips, year_month))
    dt = datetime_dim(good)
    fact = fact_table(good, dt)
    location = zones.select(F.col("LocationID").cast("bigint").alias("LocationID"),
                            "Borough", "Zone", "service_zone")
    return {"datetime_dim": dt, "fact_trips": fact, "location_dim": location, **static}
