"""Readers: missing-value tokens in CSV, month taken from the file, landing report."""

import datetime as dt

from pyspark.sql import functions as F

from tripmart.schemas import RAW_TRIPS, ZONE_LOOKUP
from tripmart.session import local_path, scratch_path
from tripmart.sources import files


def test_csv_missing_tokens_become_null(spark):
    path = scratch_path(spark, "t-csv")
    import os
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "zones.csv"), "w") as fh:
        fh.write("LocationID,Borough,Zone,service_zone\n"
                 "1,EWR,Newark Airport,EWR\n2,NA,N/A,\n3,Queens,NULL,Boro Zone\n4,,nan,None\n")
    rows = {r.LocationID: r for r in files.read_lookup(spark, path, ZONE_LOOKUP).collect()}
    assert rows[1].Zone == "Newark Airport"
    assert rows[2].Borough is None and rows[2].Zone is None and rows[2].service_zone is None
    assert rows[3].Zone is None and rows[3].service_zone == "Boro Zone"
    assert rows[4].Borough is None and rows[4].Zone is None and rows[4].service_zone is None


def test_month_comes_from_the_file_not_the_pickup(spark):
    root = scratch_path(spark, "t-files")
    t0 = dt.datetime(2024, 2, 29, 23, 50)
    row = (1, t0, t0 + dt.timedelta(minutes=20), 1.0, 1.0, 1, "N", 1, 1, 1, 5.0, 0.0, 0.5,
           0.0, 0.0, 1.0, 6.5, 2.5, 0.0)
    df = spark.createDataFrame([row], RAW_TRIPS)
    # a month file whose trip starts in the previous month, written with other types
    df.withColumn("VendorID", F.col("VendorID").cast("int")) \
        .withColumnRenamed("Airport_fee", "airport_fee") \
        .write.parquet(files.month_file(root, "2024-03"))
    df.write.parquet(files.month_file(root, "2024-02"))
    got = files.read_trips(spark, root, layout="files")
    assert sorted(r.year_month for r in got.collect()) == ["2024-02", "2024-03"]
    assert files.available_files(spark, root) == ["2024-02", "2024-03"]
    one = files.read_trips(spark, root, ["2024-03"], layout="files").collect()
    assert len(one) == 1 and one[0].year_month == "2024-03" and one[0].Airport_fee == 0.0


def test_landing_report_refuses_tiny_files(spark):
    import os
    root = scratch_path(spark, "t-land")
    os.makedirs(local_path(root), exist_ok=True)
    with open(os.path.join(local_path(root), "yellow_tripdata_2024-05.parquet"), "wb") as fh:
        fh.write(b"PAR1" + b"0" * 10)
    rep = files.landing_report(spark, f"{root}/yellow_tripdata_*").collect()
    assert len(rep) == 1 and rep[0].year_month == "2024-05" and rep[0].accepted is False


def _month(spark, rows, **types):
    t0 = dt.datetime(2024, 2, 10, 8, 0)
    row = (1, t0, t0 + dt.timedelta(minutes=20), 1.0, 1.0, 1, "N", 1, 1, 1, 5.0, 0.0, 0.5,
           0.0, 0.0, 1.0, 6.5, 2.5, 1.25)
    df = spark.createDataFrame([row] * rows, RAW_TRIPS)
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def test_partitioned_months_keep_their_own_schema(spark):
    root = scratch_path(spark, "t-drift")
    _month(spark, 3).drop("Airport_fee").write.parquet(f"{root}/year_month=2024-01")
    _month(spark, 4).withColumnRenamed("Airport_fee", "airport_fee").write.parquet(
        f"{root}/year_month=2024-02")
    _month(spark, 5, passenger_count="bigint").write.parquet(f"{root}/year_month=2024-03")
    got = files.read_trips(spark, root)
    fees = {r.year_month: r.n for r in got.groupBy("year_month").agg(
        F.count("Airport_fee").alias("n")).collect()}
    assert fees == {"2024-01": 0, "2024-02": 4, "2024-03": 5}
    assert got.filter("passenger_count = 1").count() == 12
    assert [r.year_month for r in files.read_trips(spark, root, ["2024-02"]).select(
        "year_month").distinct().collect()] == ["2024-02"]


def test_plan_grows_with_schemas_not_months(spark):
    root = scratch_path(spark, "t-many")
    for m in range(1, 7):
        part = _month(spark, 2) if m % 2 else _month(spark, 2).drop("Airport_fee")
        part.write.parquet(f"{root}/year_month=2024-0{m}")
    plan = files.read_trips(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_many_small_parts_are_one_month(spark):
    root = scratch_path(spark, "t-parts")
    _month(spark, 30).repartition(10).write.parquet(f"{root}/year_month=2024-01")
    files_ = files.landing_report(spark, f"{root}/year_month=*", 30_000).collect()
    assert all(f.bytes < 30_000 and f.accepted for f in files_)


def test_undersized_month_raises(spark):
    import os

    import pytest
    root = scratch_path(spark, "t-small")
    _month(spark, 3).write.parquet(f"{root}/year_month=2024-01")
    os.makedirs(local_path(f"{root}/year_month=2024-02"))
    with open(local_path(f"{root}/year_month=2024-02/a.parquet"), "wb") as fh:
        fh.write(b"PAR1" * 5)
    with pytest.raises(ValueError, match="2024-02 .20 bytes"):
        files.read_trips(spark, root)
    assert files.read_trips(spark, root, ["2024-01"]).count() == 3
    with pytest.raises(FileNotFoundError, match="2024-07"):
        files.read_trips(spark, root, ["2024-07"])


def test_csv_quotes_and_line_breaks(spark):
    import os
    path = scratch_path(spark, "t-quotes")
    os.makedirs(local_path(path))
    with open(os.path.join(local_path(path), "z.csv"), "w") as fh:
        fh.write('LocationID,Borough,Zone,service_zone\n1,"a ""b"" c","x\ny",Z\n2,q,r,s\n')
    rows = {r.LocationID: r for r in files.read_lookup(spark, path, ZONE_LOOKUP).collect()}
    assert rows[1].Borough == 'a "b" c' and rows[1].Zone == "x\ny" and rows[2].Zone == "r"


def test_drifting_months_of_all_years(spark):
    import __spark_entry__ as E
    from tripmart import fixtures

    got = E.queries()["s1_drifting_all_months"](spark, "/root/testdata/sf0.001")
    both = [F.count(F.lit(1)).alias("n"), F.count("Airport_fee").alias("fees")]
    got = {r["year_month"]: (r["n"], r["fees"]) for r in got.groupBy("year_month").agg(*both).collect()}
    want = {r["year_month"]: (r["n"], r["n"] if int(r["year_month"][5:]) % 2 == 0 else 0)
            for r in fixtures.trips(spark, "/root/testdata/sf0.001").groupBy("year_month").agg(*both).collect()}
    assert got == want and len({m[:4] for m in got}) > 1


def test_months_as_a_data_source(spark):
    import os

    import pytest
    from pyspark.errors import PySparkException
    from tripmart import fixtures
    from tripmart.sources import month_source

    from conftest import SMALL
    root = scratch_path(spark, "t-source")
    raw = fixtures.trips(spark, SMALL).drop("trip_key").filter("year_month LIKE '1996-%'")
    odd = F.substring("year_month", 7, 1).cast("int") % 2 == 1
    raw.filter(odd).drop("congestion_surcharge").withColumn("VendorID", F.when(
        F.col("VendorID").isNull(), F.lit(float("nan"))).otherwise(F.col("VendorID").cast("double"))) \
        .withColumnRenamed("Airport_fee", "airport_FEE").write.partitionBy("year_month").parquet(root)
    raw.filter(~odd).write.mode("append").partitionBy("year_month").parquet(root)
    month_source.register(spark)

    def load(**options):
        return spark.read.format("trip_months").option("root", root).options(**options).load()

    # whole months, of both schemas
    want, got = files.read_trips(spark, root), load()
    assert got.dtypes == want.dtypes and got.rdd.getNumPartitions() == 12
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0

    # a broken month, and one that is too small, do not matter to a filter that leaves them out
    for month, size in (("1995-01", 5000), ("1995-02", 10)):
        folder = os.path.join(local_path(root), f"year_month={month}")
        os.makedirs(folder)
        with open(os.path.join(folder, "part.parquet"), "wb") as fh:
            fh.write(b"x" * size)
    for text, months in (("year_month = '1996-03'", 1), ("year_month IN ('1996-03', '1996-04')", 2),
                         ("year_month > '1996-10'", 2), ("year_month LIKE '1996-1%'", 3),
                         ("year_month BETWEEN '1996-02' AND '1996-05' AND passenger_count > 1", 4)):
        some = load().filter(text)
        assert some.rdd.getNumPartitions() == months, text
        assert some.count() == want.filter(text).count() > 0, text
    with pytest.raises(PySparkException, match="too small to be complete: 1995-02"):
        load().count()
    with pytest.raises(PySparkException):
        load(minBytes=1).filter("year_month = '1995-01'").count()
    assert load().filter("year_month = '2020-01'").count() == 0
