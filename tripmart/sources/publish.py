"""All-or-nothing publication of warehouse tables.

Every load writes new folders, ``root/load=<id>/<table>/...``, which no reader
knows of, checks them, and then publishes all of its tables at once by adding
one small manifest file, ``root/_manifests/v<number>.json``. The newest complete
manifest says which folder holds each table and each month of a monthly table.
A reader takes one manifest and reads its folders, so it sees every table as of
one version: during a load, and after a load that failed at any point, that is
the version before.

The manifest gets its name by a rename that fails if the name is taken. Of two
loads that end together one is first; the other takes up the first one's
manifest if the two touched different tables or months, and fails otherwise.
Nothing a manifest names is changed or removed until ``clean`` drops versions
that are no longer kept.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TABLES

WHOLE = ""  # the one part of a table that is replaced as a whole
MANIFESTS = "_manifests"


class ConcurrentLoad(RuntimeError):
    """Another load published the same table or month in the meantime."""


class Files:
    """The few operations on folders of the shared file system that are needed."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path
        where = self.path(root)
        self.fs = where.getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.fs.getUri(), conf)
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        self.no_options = spark.sparkContext._gateway.new_array(rename, 0)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        if not self.fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where))

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write_new(self, file: str, text: str) -> bool:
        """Write ``file`` whole, or return False if there is one of that name."""
        draft = self.path(f"{file}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self.context.rename(self.context.makeQualified(draft),
                                self.context.makeQualified(self.path(file)), self.no_options)
            return True
        except Exception as e:
            self.fs.delete(draft, False)
            if "AlreadyExists" in str(e):
                return False
            raise

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


@dataclass
class Manifest:
    """One version: the folder (below the root) of every table's parts, and notes."""

    version: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    notes: dict[str, dict] = field(default_factory=dict)  # of loaded months: row counts

    def dumps(self) -> str:
        return json.dumps({"version": self.version, "tables": self.tables, "notes": self.notes},
                          sort_keys=True, indent=1)

    def folders(self) -> set[str]:
        return {f.split("/")[0] for parts in self.tables.values() for f in parts.values()}


class Published:
    """Reader and publisher of one warehouse root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def versions(self) -> list[int]:
        names = self.files.names(f"{self.root}/{MANIFESTS}")
        return [int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of ``version``; an empty one before the first load."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest()
        return Manifest(**json.loads(self.files.read(self._file(version))))

    def _file(self, version: int) -> str:
        return f"{self.root}/{MANIFESTS}/v{version:010d}.json"

    def read(self, table: str, schema: T.StructType | None = None,
             manifest: Manifest | None = None, months: Iterable[str] | None = None) -> DataFrame:
        """A table as of one manifest (default: the newest), by explicit folders.

        Monthly tables get ``year_month`` from their folders, so a filter on it
        prunes them; with ``months`` the folders of others are not even listed.
        A table that has no part is empty if its schema is known."""
        manifest = manifest or self.manifest()
        parts = manifest.tables.get(table, {})
        if months is not None and WHOLE not in parts:
            parts = {m: f for m, f in parts.items() if m in set(months)}
        schema = schema or TABLES.get(table)
        if not parts:
            if schema is None:
                raise KeyError(f"nothing is published as {table!r}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.root)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields]))
        df = reader.parquet(*[f"{self.root}/{f}" for f in sorted(parts.values())])
        if schema is not None:
            return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        hidden = [c for c in ("load", "table") if c in df.columns]
        return df.drop(*hidden)

    def star(self, manifest: Manifest | None = None,
             months: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """All six tables of one version, monthly ones of ``months`` if given."""
        manifest = manifest or self.manifest()
        return {t: self.read(t, manifest=manifest, months=months) for t in TABLES}

    def create_views(self, prefix: str = "", manifest: Manifest | None = None) -> list[str]:
        """Temporary views of all published tables, of one version, for SQL users."""
        manifest = manifest or self.manifest()
        for table in manifest.tables:
            self.read(table, manifest=manifest).createOrReplaceTempView(f"{prefix}{table}")
        return [f"{prefix}{t}" for t in manifest.tables]

    def begin(self) -> Load:
        return Load(self)

    def clean(self, keep: int = 2, min_age_seconds: float = 86_400) -> list[str]:
        """Remove manifests but the newest ``keep``, and load folders that none of
        those names and that are old enough not to belong to a running load."""
        versions = self.versions()
        kept = versions[-keep:]
        used = set().union(*[self.manifest(v).folders() for v in kept])
        for v in versions[:-keep]:
            self.files.delete(self._file(v))
        gone = []
        for name in self.files.names(self.root):
            if name.startswith("load=") and name not in used and \
                    time.time() - int(name[5:].split("-")[0]) >= min_age_seconds:
                self.files.delete(f"{self.root}/{name}")
                gone.append(name)
        return gone


class Load:
    """Tables of one load: written aside, readable through ``star`` for checks,
    and published together or not at all."""

    def __init__(self, warehouse: Published):
        self.warehouse, self.base = warehouse, warehouse.manifest()
        self.folder = f"load={int(time.time())}-{uuid.uuid4().hex[:12]}"
        self.changes: dict[str, dict[str, str | None]] = {}  # None: the part is gone
        self.notes: dict[str, dict] = {}

    def write(self, table: str, df: DataFrame) -> None:
        """A table that is replaced as a whole."""
        self._changed(table, WHOLE)
        df.write.parquet(f"{self.warehouse.root}/{self.folder}/table={table}")
        self.changes[table] = {WHOLE: f"{self.folder}/table={table}"}

    def write_months(self, table: str, df: DataFrame, months: Iterable[str]) -> None:
        """The given months of a monthly table; months without a row are emptied.
        ``df`` must hold no other months. Rows of a month meet in few files."""
        where = f"{self.folder}/table={table}"
        for month in months:
            self._changed(table, month)
        df.hint("rebalance", F.col("year_month")).write.partitionBy("year_month").parquet(
            f"{self.warehouse.root}/{where}")
        self.take_months(table, where, months)

    def take_months(self, table: str, where: str, months: Iterable[str]) -> None:
        """Make the month folders below ``where`` the months of ``table``."""
        found = {n.removeprefix("year_month="): f"{where}/{n}"
                 for n in self.warehouse.files.names(f"{self.warehouse.root}/{where}")
                 if n.startswith("year_month=")}
        extra = set(found) - set(months)
        if extra:
            raise ValueError(f"{table} was given rows of other months: {sorted(extra)}")
        self.changes.setdefault(table, {}).update({m: found.get(m) for m in months})

    def _changed(self, table: str, part: str) -> None:
        if part in self.changes.get(table, {}):
            raise ValueError(f"{table} {part} is written twice in one load")

    def staged(self) -> Manifest:
        """What would be published now: the base with this load's changes."""
        return self._applied(self.base)

    def _applied(self, base: Manifest) -> Manifest:
        tables = {t: dict(parts) for t, parts in base.tables.items()}
        for table, parts in self.changes.items():
            held = {} if WHOLE in parts else tables.get(table, {})
            held |= {k: v for k, v in parts.items() if v is not None}
            tables[table] = {k: v for k, v in held.items() if parts.get(k, v) is not None}
        return Manifest(base.version + 1, tables, {**base.notes, **self.notes})

    def star(self, months: Iterable[str] | None = None) -> dict[str, DataFrame]:
        return self.warehouse.star(self.staged(), months)

    def read(self, table: str, schema: T.StructType | None = None,
             months: Iterable[str] | None = None) -> DataFrame:
        return self.warehouse.read(table, schema, self.staged(), months)

    def publish(self) -> Manifest:
        """Make all changes visible at once."""
        while True:
            newest = self.warehouse.manifest()
            for table, parts in self.changes.items():
                for part in parts:
                    if newest.tables.get(table, {}).get(part) != self.base.tables.get(table, {}).get(part):
                        raise ConcurrentLoad(f"{table} {part or '(whole)'} changed since version "
                                             f"{self.base.version}")
            out = self._applied(newest)
            if self.warehouse.files.write_new(self.warehouse._file(out.version), out.dumps()):
                return out

