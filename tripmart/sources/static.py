"""S3: the three fixed dimensions (payment type, rate code, vendor)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PAYMENT_TYPE_DIM, RATECODE_DIM, VENDOR_DIM

# Code -> name of the three static dimensions.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "VeriFone Inc."),
]


def static_dims(spark: SparkSession) -> dict[str, DataFrame]:
    """The three literal dimension tables, keyed by warehouse table name."""
    return {
        "payment_type_dim": spark.createDataFrame(PAYMENT_TYPES, PAYMENT_TYPE_DIM),
        "Ratecode_dim": spark.createDataFrame(RATE_CODES, RATECODE_DIM),
        "vendor_dim": spark.createDataFrame(VENDORS, VENDOR_DIM),
    }
