"""Raw months as a Spark data source (S1 and S11's size rule behind one format).

    register(spark)
    spark.read.format("trip_months").option("root", root).load().filter("year_month >= '2024-01'")

One partition per landed month. Filters on ``year_month`` choose the months before
any file is opened, on the driver and in tasks; all others are left to Spark. A
chosen month whose files have less than ``minBytes`` together raises, as in
``files.read_trips``; months that the filters leave out may be of any size.

Options: ``root``; ``layout`` ("partitioned" or "files", as in ``files``);
``minBytes``. Files are read by pyarrow, row group by row group, so memory does not
grow with a month, from any store that ``pyarrow.fs`` reaches under the same address
as Spark. ``files.read_trips`` reads with Spark's own vectorized reader and splits
large months, and stays the way to load; this format is for ad-hoc reads by month.

Defined results: columns are matched by name in any case, absent ones are NULL;
numbers that mark missing values by NaN are NULL in whole-number columns; texts
that are no number or time raise; a folder without months gives no rows.

The classes are made inside a function, so that workers get them with the task and
need no copy of this package.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..schemas import RAW_TRIPS
from .files import MIN_MONTH_BYTES, MONTH_IN_PATH

FORMAT = "trip_months"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("trip_months")`` known, with filters pushed down."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(_source())


def _source() -> type:
    from pyspark.sql import datasource as D

    columns = [(f.name, f.dataType.typeName()) for f in RAW_TRIPS.fields]
    whole = T.StructType([*RAW_TRIPS.fields, T.StructField("year_month", T.StringType())])
    name, pattern, least = FORMAT, MONTH_IN_PATH, MIN_MONTH_BYTES

    class Month(D.InputPartition):
        def __init__(self, year_month: str, paths: list[str]):
            super().__init__(year_month)
            self.paths = paths

    class Reader(D.DataSourceReader):
        def __init__(self, options):
            self.root = options["root"].rstrip("/")
            self.layout = options.get("layout", "partitioned")
            self.least = int(options.get("minBytes", least))
            self.wanted = []  # (operation, value) that a month must meet
            if self.layout not in ("partitioned", "files"):
                raise ValueError(f"unknown layout {self.layout!r}")

        def pushFilters(self, filters):
            kinds = {D.EqualTo: "=", D.In: "in", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=",
                     D.LessThan: "<", D.LessThanOrEqual: "<=", D.StringStartsWith: "starts"}
            for f in filters:
                if getattr(f, "attribute", None) == ("year_month",) and type(f) in kinds:
                    self.wanted.append((kinds[type(f)], f.value))
                elif type(f) is D.IsNotNull and f.attribute == ("year_month",):
                    pass  # a month always has its name
                else:
                    yield f

        def _chosen(self, month: str) -> bool:
            holds = {"=": lambda v: month == v, "in": lambda v: month in v, ">": lambda v: month > v,
                     ">=": lambda v: month >= v, "<": lambda v: month < v, "<=": lambda v: month <= v,
                     "starts": lambda v: month.startswith(v)}
            return all(holds[kind](value) for kind, value in self.wanted)

        def partitions(self):
            import re

            from pyarrow import fs

            store, root = fs.FileSystem.from_uri(self.root if ":" in self.root else f"file://{self.root}")
            start = "year_month=" if self.layout == "partitioned" else "yellow_tripdata_"
            found: dict[str, list] = {}
            for entry in store.get_file_info(fs.FileSelector(root)):
                month = re.search(pattern, entry.base_name)
                if not (entry.base_name.startswith(start) and month and self._chosen(month[1])):
                    continue
                inside = [entry] if entry.is_file else store.get_file_info(
                    fs.FileSelector(entry.path, recursive=True))
                found.setdefault(month[1], []).extend(
                    f for f in inside if f.is_file and f.base_name.endswith(".parquet")
                    and not f.base_name.startswith(("_", ".")))
            small = [f"{m} ({n} bytes)" for m, files in sorted(found.items())
                     if (n := sum(f.size for f in files)) < self.least]
            if small:
                raise ValueError(f"landed months too small to be complete: {', '.join(small)}")
            months = [Month(m, sorted(f.path for f in files)) for m, files in sorted(found.items())]
            return months or [Month("", [])]

        def read(self, month):
            import pyarrow as pa
            import pyarrow.compute as pc
            import pyarrow.parquet as pq
            from pyarrow import fs

            types = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(),
                     "timestamp_ntz": pa.timestamp("us")}
            store, _ = fs.FileSystem.from_uri(self.root if ":" in self.root else f"file://{self.root}")
            for path in month.paths:
                with store.open_input_file(path) as handle:
                    parquet = pq.ParquetFile(handle)
                    present = {c.lower(): c for c in parquet.schema_arrow.names}
                    read = [present[c.lower()] for c, _ in columns if c.lower() in present]
                    for batch in parquet.iter_batches(columns=read):
                        arrays = []
                        for column, kind in columns:
                            if column.lower() not in present:
                                arrays.append(pa.nulls(batch.num_rows, types[kind]))
                                continue
                            values = batch.column(present[column.lower()])
                            if kind == "long" and pa.types.is_floating(values.type):
                                values = pc.if_else(pc.is_nan(values), None, values)
                                arrays.append(pc.cast(pc.trunc(values), types[kind]))
                            elif kind == "timestamp_ntz" and pa.types.is_timestamp(values.type):
                                arrays.append(values.cast(pa.timestamp("us", values.type.tz), safe=False)
                                              .cast(types[kind]))
                            else:
                                arrays.append(values.cast(types[kind]))
                        arrays.append(pa.array([month.value] * batch.num_rows, pa.string()))
                        yield pa.RecordBatch.from_arrays(arrays, [c for c, _ in columns] + ["year_month"])

    class TripMonths(D.DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return whole

        def reader(self, schema):
            return Reader(self.options)

    return TripMonths
