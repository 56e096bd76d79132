"""DuckDB SQL that computes the same results as the registered Spark queries.

The driver runs these against its pre-registered views of the test tables.
Fragments below rebuild the trip-shaped frames (``tripmart.fixtures``) and
the star with DuckDB's own functions, so each oracle is independent of the
Spark code it checks.
"""

from __future__ import annotations

from ..sources.static import PAYMENT_TYPES, RATE_CODES, VENDORS

PICKUP = ("o_orderdate + to_hours(cast(l_orderkey % 24 as int)) "
          "+ to_minutes(cast(l_partkey % 60 as int))")
SHIFT = ("to_minutes(cast((l_partkey * 7 + l_linenumber * 13) % 95 - 4 as int)) "
         "+ to_seconds(cast(l_orderkey % 60 as int))")

TRIPS = f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_key,
  strftime(o_orderdate, '%Y-%m') AS year_month,
  CASE WHEN l_suppkey % 4 = 3 THEN NULL ELSE l_suppkey % 4 END AS VendorID,
  {PICKUP} AS tpep_pickup_datetime,
  {PICKUP} + {SHIFT} AS tpep_dropoff_datetime,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
  (l_quantity - 1) / 4 AS trip_distance,
  CAST(l_suppkey % 30 AS BIGINT) AS PULocationID,
  CAST(l_partkey % 27 AS BIGINT) AS DOLocationID,
  CAST(l_orderkey % 8 AS BIGINT) AS payment_type,
  CAST(l_linenumber AS BIGINT) AS RatecodeID,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS store_and_fwd_flag,
  CASE WHEN l_partkey % 40 = 1 THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
  l_tax AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, l_discount * 100 AS tip_amount,
  CAST(0 AS DOUBLE) AS tolls_amount, CAST(1 AS DOUBLE) AS improvement_surcharge,
  l_extendedprice + l_tax AS total_amount,
  CAST(2.5 AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS Airport_fee
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

ZONES = """
SELECT CAST(n_nationkey AS BIGINT) AS LocationID,
  CASE WHEN n_nationkey = 23 THEN NULL ELSE r_name END AS Borough,
  CASE WHEN n_nationkey = 22 THEN NULL ELSE n_name END AS Zone,
  CASE WHEN n_nationkey % 2 = 0 THEN 'Zone A' ELSE 'Zone B' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def _values(rows, key, name):
    body = ", ".join(f"({k}, '{v}')" for k, v in rows)
    return f"SELECT CAST(k AS BIGINT) AS {key}, v AS {name} FROM (VALUES {body}) t(k, v)"


PAYMENT = _values(PAYMENT_TYPES, "payment_type", "payment_name")
RATE = _values(RATE_CODES, "RatecodeID", "ratecode_name")
VENDOR = _values(VENDORS, "VendorID", "vendor_name")


def calendar(col: str, prefix: str) -> str:
    return (f"CAST(hour({col}) AS BIGINT) AS {prefix}_hour, "
            f"CAST(day({col}) AS BIGINT) AS {prefix}_day, "
            f"CAST(month({col}) AS BIGINT) AS {prefix}_month, "
            f"CAST(year({col}) AS BIGINT) AS {prefix}_year, "
            f"CAST(isodow({col}) - 1 AS BIGINT) AS {prefix}_weekday, "
            f"CAST({col} AS DATE) AS {prefix}_date")


DATETIME_DIM = f"""
SELECT datetime_id, tpep_pickup_datetime, tpep_dropoff_datetime, year_month,
  {calendar('tpep_pickup_datetime', 'pickup')},
  {calendar('tpep_dropoff_datetime', 'dropoff')}
FROM (
  SELECT year_month, tpep_pickup_datetime, tpep_dropoff_datetime,
    CAST(row_number() OVER (PARTITION BY year_month
      ORDER BY tpep_pickup_datetime, tpep_dropoff_datetime) - 1 AS BIGINT) AS datetime_id
  FROM (SELECT DISTINCT year_month, tpep_pickup_datetime, tpep_dropoff_datetime FROM trips) p
) k
"""

FACT = """
SELECT coalesce(t.VendorID, 0) AS VendorID, d.datetime_id,
  coalesce(t.passenger_count, 0.0) AS passenger_count,
  coalesce(t.trip_distance, 0.0) AS trip_distance,
  coalesce(t.PULocationID, 0) AS PULocationID, coalesce(t.DOLocationID, 0) AS DOLocationID,
  coalesce(t.payment_type, 0) AS payment_type, coalesce(t.RatecodeID, 0) AS RatecodeID,
  coalesce(t.store_and_fwd_flag, 'N') AS store_and_fwd_flag,
  coalesce(t.fare_amount, 0.0) AS fare_amount, coalesce(t.extra, 0.0) AS extra,
  coalesce(t.mta_tax, 0.0) AS mta_tax, coalesce(t.tip_amount, 0.0) AS tip_amount,
  coalesce(t.tolls_amount, 0.0) AS tolls_amount,
  coalesce(t.improvement_surcharge, 0.0) AS improvement_surcharge,
  coalesce(t.total_amount, 0.0) AS total_amount,
  coalesce(t.congestion_surcharge, 0.0) AS congestion_surcharge,
  coalesce(t.Airport_fee, 0.0) AS Airport_fee,
  t.year_month, t.trip_key
FROM trips t JOIN datetime_dim d
  ON t.year_month = d.year_month AND t.tpep_pickup_datetime = d.tpep_pickup_datetime
  AND t.tpep_dropoff_datetime = d.tpep_dropoff_datetime
"""

TRIP_METRICS = """
SELECT v.VendorID, v.vendor_name,
  d.tpep_pickup_datetime, d.pickup_hour, d.pickup_day, d.pickup_month, d.pickup_year,
  d.pickup_weekday,
  d.tpep_dropoff_datetime, d.dropoff_hour, d.dropoff_day, d.dropoff_month, d.dropoff_year,
  d.dropoff_weekday,
  f.passenger_count, f.trip_distance, r.ratecode_name,
  pu.Borough AS pickup_Borough, pu.Zone AS pickup_Zone, pu.service_zone AS pickup_service_zone,
  dz.Borough AS dropoff_Borough, dz.Zone AS dropoff_Zone,
  dz.service_zone AS dropoff_service_zone,
  pay.payment_name, f.fare_amount, f.extra, f.mta_tax, f.tip_amount, f.tolls_amount,
  f.improvement_surcharge, f.total_amount, f.congestion_surcharge, f.Airport_fee,
  date_sub('minute', d.tpep_pickup_datetime, d.tpep_dropoff_datetime) AS trip_duration_minutes,
  CAST(CASE WHEN f.tip_amount > 0 THEN 1 ELSE 0 END AS BIGINT) AS has_tip,
  CASE WHEN f.trip_distance > 0 THEN f.fare_amount / f.trip_distance ELSE 0.0 END
    AS fare_per_mile
FROM fact_trips f
JOIN datetime_dim d ON f.year_month = d.year_month AND f.datetime_id = d.datetime_id
JOIN vendor_dim v ON v.VendorID = f.VendorID
JOIN ratecode_dim r ON r.RatecodeID = f.RatecodeID
JOIN location_dim pu ON pu.LocationID = f.PULocationID
JOIN location_dim dz ON dz.LocationID = f.DOLocationID
JOIN payment_type_dim pay ON pay.payment_type = f.payment_type
"""

KEPT = """
SELECT * FROM trip_metrics
WHERE trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
  AND passenger_count > 0 AND passenger_count <= 6
"""


def period(col: str) -> str:
    return (f"CASE WHEN {col} BETWEEN 6 AND 10 THEN 'Morning Rush' "
            f"WHEN {col} BETWEEN 16 AND 19 THEN 'Evening Rush' "
            f"WHEN {col} >= 23 OR {col} <= 4 THEN 'Night' ELSE 'Off Peak' END")


DISTANCE_CATEGORY = ("CASE WHEN trip_distance <= 1 THEN 'Very Short' "
                     "WHEN trip_distance <= 3 THEN 'Short' "
                     "WHEN trip_distance <= 5 THEN 'Medium' "
                     "WHEN trip_distance <= 10 THEN 'Long' ELSE 'Very Long' END")

# Averages and medians are rounded on both sides: the engines add in
# different orders, so the last bits of a double can differ.
METRICS = {
    "avg_pickup_hourly_fare": "round(AVG(fare_amount) OVER (PARTITION BY pickup_hour), 6)",
    "avg_pickup_hourly_distance":
        "round(AVG(trip_distance) OVER (PARTITION BY pickup_hour), 6)",
    "pickup_trips_per_zone": "COUNT(*) OVER (PARTITION BY pickup_Borough, pickup_Zone)",
    "avg_dropoff_hourly_fare": "round(AVG(fare_amount) OVER (PARTITION BY dropoff_hour), 6)",
    "avg_dropoff_hourly_distance":
        "round(AVG(trip_distance) OVER (PARTITION BY dropoff_hour), 6)",
    "dropoff_trips_per_zone": "COUNT(*) OVER (PARTITION BY dropoff_Borough, dropoff_Zone)",
    "avg_tip_by_passengers":
        "round(AVG(tip_amount) OVER (PARTITION BY CAST(passenger_count AS VARCHAR)), 6)",
    "median_fare": "round(quantile_cont(fare_amount, 0.5) OVER (), 6)",
    "median_distance": "round(quantile_cont(trip_distance, 0.5) OVER (), 6)",
}
LABELS = {
    "pickup_time_period": period("pickup_hour"),
    "dropoff_time_period": period("dropoff_hour"),
    "distance_category": DISTANCE_CATEGORY,
}


def dashboard_sql() -> str:
    metrics = ",\n  ".join(f"{expr} AS {name}" for name, expr in METRICS.items())
    labels = ",\n  ".join(f"{expr} AS {name}" for name, expr in LABELS.items())
    return sql(f"SELECT *,\n  {metrics},\n  {labels}\nFROM kept", "kept")


# --- model B (coordinate star) and training inputs -------------------------

def _coord(prefix: str) -> str:
    return (f"SELECT id AS {prefix}_location_id, "
            f"CAST(40.5 AS DOUBLE) + CAST(id AS DOUBLE) * CAST(0.01 AS DOUBLE) AS {prefix}_latitude, "
            f"CAST(-74.2 AS DOUBLE) + CAST(id AS DOUBLE) * CAST(0.01 AS DOUBLE) "
            f"AS {prefix}_longitude FROM loc_ids")


def md5_bucket(key: str, seed: int = 42, buckets: int = 10000) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % {buckets})"


MODEL_B = {
    "fact_b": """SELECT trip_key, trip_key AS datetime_id,
        PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
        CAST(round(trip_distance * 4) AS BIGINT) AS trip_distance_id,
        CAST(coalesce(passenger_count, 0) AS BIGINT) AS passenger_count_id FROM trips""",
    "dt_b": """SELECT trip_key AS datetime_id, tpep_pickup_datetime, tpep_dropoff_datetime
        FROM trips""",
    "loc_ids": "SELECT PULocationID AS id FROM trips UNION SELECT DOLocationID FROM trips",
    "pickup_location_dim": _coord("pickup"),
    "dropoff_location_dim": _coord("dropoff"),
    "trip_distance_dim": """SELECT DISTINCT trip_distance_id,
        CAST(trip_distance_id AS DOUBLE) / CAST(4.0 AS DOUBLE) AS trip_distance FROM fact_b""",
    "passenger_count_dim": """SELECT DISTINCT passenger_count_id,
        CAST(passenger_count_id AS DOUBLE) AS passenger_count FROM fact_b""",
    "looked_up": """SELECT s.*, d.tpep_pickup_datetime, d.tpep_dropoff_datetime,
        p.pickup_latitude, p.pickup_longitude, q.dropoff_latitude, q.dropoff_longitude,
        t.trip_distance, c.passenger_count
      FROM fact_b s
      LEFT JOIN dt_b d ON s.datetime_id = d.datetime_id
      LEFT JOIN pickup_location_dim p ON s.pickup_location_id = p.pickup_location_id
      LEFT JOIN dropoff_location_dim q ON s.dropoff_location_id = q.dropoff_location_id
      LEFT JOIN trip_distance_dim t ON s.trip_distance_id = t.trip_distance_id
      LEFT JOIN passenger_count_dim c ON s.passenger_count_id = c.passenger_count_id""",
    "training": """SELECT * FROM (
        SELECT *, CAST(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime) AS DOUBLE)
            / 60e6 AS trip_duration,
          CAST(hour(tpep_pickup_datetime) AS BIGINT) AS pickup_hour,
          CAST(isodow(tpep_pickup_datetime) - 1 AS BIGINT) AS pickup_weekday,
          CAST(tpep_pickup_datetime AS DATE) AS pickup_date
        FROM looked_up) x WHERE trip_duration > 0""",
    "demand": """SELECT pickup_location_id, pickup_hour, pickup_weekday, pickup_date,
        count(*) AS trip_count FROM training
      WHERE pickup_location_id IS NOT NULL AND pickup_hour IS NOT NULL
        AND pickup_weekday IS NOT NULL AND pickup_date IS NOT NULL
      GROUP BY ALL""",
}
MODEL_B_DEPS = {
    "fact_b": ["trips"], "dt_b": ["trips"], "loc_ids": ["trips"],
    "pickup_location_dim": ["loc_ids"], "dropoff_location_dim": ["loc_ids"],
    "trip_distance_dim": ["fact_b"], "passenger_count_dim": ["fact_b"],
    "looked_up": ["fact_b", "dt_b", "pickup_location_dim", "dropoff_location_dim",
                  "trip_distance_dim", "passenger_count_dim"],
    "training": ["looked_up"], "demand": ["training"],
}


KEPT_ONCE = ("trips", "datetime_dim", "fact_trips", "fact_b", "looked_up")


def sql(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs, their dependencies first."""
    available = {
        "trips": TRIPS, "zones": ZONES, "payment_type_dim": PAYMENT,
        "ratecode_dim": RATE, "vendor_dim": VENDOR, "datetime_dim": DATETIME_DIM,
        "fact_trips": FACT, "location_dim": "SELECT * FROM zones",
        "trip_metrics": TRIP_METRICS, "kept": KEPT, **MODEL_B,
    }
    deps = {
        "datetime_dim": ["trips"], "fact_trips": ["trips", "datetime_dim"],
        "location_dim": ["zones"],
        "trip_metrics": ["fact_trips", "datetime_dim", "vendor_dim", "ratecode_dim",
                         "location_dim", "payment_type_dim"],
        "kept": ["trip_metrics"], **MODEL_B_DEPS,
    }
    order: list[str] = []

    def add(n: str) -> None:
        for d in deps.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    # read several times in one query: computed once
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in KEPT_ONCE else ''}({available[n]})"
                      for n in order)
    return f"WITH {ctes}\n{body}" if order else body
