"""Benchmark of the headline queries.

Runs each query once to warm up and then three times, all in one session,
and prints one JSON line with the median seconds per query. Results go to
Spark's no-op sink, so every row is computed but nothing is collected.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tripmart import fixtures  # noqa: E402
from tripmart.operators import audit, dashboard as dash, demand as dem, months as mon  # noqa: E402
from tripmart.operators.keys import assign_key  # noqa: E402
from tripmart.operators.star import build_star  # noqa: E402
from tripmart.plans import registry  # noqa: E402
from tripmart.schemas import KEYS, REQUIRED  # noqa: E402
from tripmart.session import build_session, scratch_path  # noqa: E402
from tripmart.sources import warehouse  # noqa: E402
from tripmart.sources.static import static_dims  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    # local mode runs every task in the driver JVM: give it a real heap
    spark = build_session(f"local[{cpus}]", cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})

    # The star is built and stored once; the dashboard and audit queries read
    # it from Parquet like they would read the warehouse.
    root = scratch_path(spark, "bench-star")
    trips = fixtures.trips(spark, sf_dir)
    zones = fixtures.zones(spark, sf_dir)
    warehouse.write_star(build_star(trips, zones, static_dims(spark)), root)

    def star():
        return warehouse.read_star(spark, root)

    # the same star as catalog tables, calendar join co-bucketed (made on first use)
    import uuid
    db = f"bench_{uuid.uuid4().hex[:8]}"
    made = []

    def bucketed_dashboard():
        if not made:
            warehouse.save_star_tables(warehouse.read_star(spark, root), db, buckets=cpus * 4,
                                       location=scratch_path(spark, "bench-db"))
            made.append(db)
        key = "spark.sql.requireAllClusterKeysForCoPartition"
        old = spark.conf.get(key)
        spark.conf.set(key, "false")
        try:
            noop(dash.dashboard(warehouse.read_catalog_star(spark, db), materialize="none"))
        finally:
            spark.conf.set(key, old)

    def dense_key():
        pairs = fixtures.trips(spark, sf_dir).select(
            "year_month", "tpep_pickup_datetime", "tpep_dropoff_datetime").distinct()
        keyed = assign_key(pairs, ["tpep_pickup_datetime", "tpep_dropoff_datetime"],
                           "datetime_id", group_cols=["year_month"]).persist()
        # check: per month the keys are exactly 0..n-1
        bad = keyed.groupBy("year_month").agg(
            F.count(F.lit(1)).alias("n"), F.min("datetime_id").alias("lo"),
            F.max("datetime_id").alias("hi"), F.countDistinct("datetime_id").alias("k")
        ).filter("lo != 0 OR hi != n - 1 OR k != n").count()
        keyed.unpersist()
        assert bad == 0, "dense key check failed"

    queries = {
        "star_build": lambda: noop(build_star(fixtures.trips(spark, sf_dir),
                                              fixtures.zones(spark, sf_dir),
                                              static_dims(spark))["fact_trips"]),
        "dense_key": dense_key,
        "dashboard": lambda: noop(dash.dashboard(star())),
        # both medians in the dashboard's way, its base included
        "medians_distributed": lambda: dash.medians(
            dash.trip_base(star()).select("fare_amount", "trip_distance").checkpoint(),
            ["fare_amount", "trip_distance"]),
        "demand": lambda: noop(registry.demand_table(spark, sf_dir)),
        "audits": lambda: noop(audit.key_report(star(), KEYS).unionByName(
            audit.table_counts(star()).select(
                "table_name", F.col("row_count").alias("duplicate_keys"),
                F.lit(0).cast("bigint").alias("duplicate_rows")))),
        "required": lambda: noop(audit.required_violations(star(), REQUIRED)),
        "pending_months": lambda: noop(mon.pending_months(
            mon.available_months(trips.select(
                F.substring("year_month", 1, 4).cast("int").alias("year")), "1998-09-15"),
            trips.select("year_month"),
            mon.loaded_months(star()["fact_trips"], star()["datetime_dim"]))),
    }
    # Variants for large data, run only on request (BENCH_EXTRA=1 or BENCH_ONLY):
    # the base not kept, and the catalog layout with the calendar join
    # co-bucketed (at sf0.1 its thousands of tiny bucket files dominate).
    extras = {
        "dashboard_unkept": lambda: noop(dash.dashboard(star(), materialize="none")),
        "dashboard_bucketed": bucketed_dashboard,
    }
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    if only or os.environ.get("BENCH_EXTRA"):
        queries.update(extras)
    results, errors = {}, {}
    for name, fn in queries.items():
        if only and name not in only:
            continue
        try:
            fn()  # warm-up
            times = []
            for _ in range(runs):
                spark.catalog.clearCache()  # no run reads what an earlier one kept
                t0 = time.perf_counter()
                fn()
                times.append(time.perf_counter() - t0)
            results[name] = round(statistics.median(times), 3)
        except Exception as exc:  # report and keep measuring the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
        finally:
            spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": sf, "cpus": cpus, "runs": runs,
                      **({"errors": errors} if errors else {})}))


if __name__ == "__main__":
    main()
