"""Declared table schemas of the trip star, plus keys and required columns.

Where the table DDL and the load schema disagree on nullability, the
stricter one is kept. Parquet forgets ``nullable=False`` on read, so the
REQUIRED and KEY declarations below are enforced by audit queries
(``operators.audit``), not by the schema objects.
"""

from __future__ import annotations

from pyspark.sql import types as T

BIGINT = T.LongType()
DOUBLE = T.DoubleType()
STRING = T.StringType()
TS = T.TimestampNTZType()
DATE = T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Integer columns of a raw month that are filled with 0 when missing.
RAW_INT_COLUMNS = ["VendorID", "PULocationID", "DOLocationID", "payment_type", "RatecodeID"]
# Double columns of a raw month that are filled with 0.0 when missing.
RAW_DOUBLE_COLUMNS = [
    "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
    "Airport_fee",
]

RAW_TRIPS = _struct(
    ("VendorID", BIGINT),
    ("tpep_pickup_datetime", TS),
    ("tpep_dropoff_datetime", TS),
    ("passenger_count", DOUBLE),
    ("trip_distance", DOUBLE),
    ("RatecodeID", BIGINT),
    ("store_and_fwd_flag", STRING),
    ("PULocationID", BIGINT),
    ("DOLocationID", BIGINT),
    ("payment_type", BIGINT),
    ("fare_amount", DOUBLE),
    ("extra", DOUBLE),
    ("mta_tax", DOUBLE),
    ("tip_amount", DOUBLE),
    ("tolls_amount", DOUBLE),
    ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE),
    ("congestion_surcharge", DOUBLE),
    ("Airport_fee", DOUBLE),
)

ZONE_LOOKUP = _struct(
    ("LocationID", BIGINT),
    ("Borough", STRING),
    ("Zone", STRING),
    ("service_zone", STRING),
)
LOCATION_DIM = ZONE_LOOKUP

CALENDAR_PARTS = ["hour", "day", "month", "year", "weekday"]

DATETIME_DIM = _struct(
    ("datetime_id", BIGINT),
    ("tpep_pickup_datetime", TS),
    ("tpep_dropoff_datetime", TS),
    ("year_month", STRING),
    *[(f"pickup_{p}", BIGINT) for p in CALENDAR_PARTS],
    ("pickup_date", DATE),
    *[(f"dropoff_{p}", BIGINT) for p in CALENDAR_PARTS],
    ("dropoff_date", DATE),
)

PAYMENT_TYPE_DIM = _struct(("payment_type", BIGINT), ("payment_name", STRING))
RATECODE_DIM = _struct(("RatecodeID", BIGINT), ("ratecode_name", STRING))
VENDOR_DIM = _struct(("VendorID", BIGINT), ("vendor_name", STRING))

FACT_COLUMNS = [
    "VendorID", "datetime_id", "passenger_count", "trip_distance", "PULocationID",
    "DOLocationID", "payment_type", "RatecodeID", "store_and_fwd_flag", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "Airport_fee",
]
# The fact carries its load month as well, so that the per-month surrogate
# key ``datetime_id`` is unique together with it.
FACT_TRIPS = _struct(
    *[(name, BIGINT if name in RAW_INT_COLUMNS or name == "datetime_id"
       else STRING if name == "store_and_fwd_flag" else DOUBLE) for name in FACT_COLUMNS],
    ("year_month", STRING),
)

TABLES: dict[str, T.StructType] = {
    "location_dim": LOCATION_DIM,
    "datetime_dim": DATETIME_DIM,
    "payment_type_dim": PAYMENT_TYPE_DIM,
    "Ratecode_dim": RATECODE_DIM,
    "vendor_dim": VENDOR_DIM,
    "fact_trips": FACT_TRIPS,
}

# Declared primary keys. datetime_id repeats across months, so year_month is
# part of the key of both month-partitioned tables.
KEYS: dict[str, list[str]] = {
    "location_dim": ["LocationID"],
    "datetime_dim": ["year_month", "datetime_id"],
    "payment_type_dim": ["payment_type"],
    "Ratecode_dim": ["RatecodeID"],
    "vendor_dim": ["VendorID"],
    "fact_trips": ["year_month", "VendorID", "datetime_id", "PULocationID", "DOLocationID",
                   "RatecodeID", "payment_type"],
}

# Columns declared REQUIRED (never NULL) at load.
REQUIRED: dict[str, list[str]] = {
    "location_dim": ["LocationID"],
    "datetime_dim": ["datetime_id", "year_month"],
    "payment_type_dim": ["payment_type"],
    "Ratecode_dim": ["RatecodeID"],
    "vendor_dim": ["VendorID"],
    "fact_trips": [],
}

# Tables replaced on every load vs. tables whose month partition is replaced.
DIMENSION_TABLES = ["payment_type_dim", "Ratecode_dim", "location_dim", "vendor_dim"]
MONTHLY_TABLES = ["datetime_dim", "fact_trips"]
