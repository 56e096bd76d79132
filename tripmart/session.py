"""Session helpers: configuration and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every tripmart job relies on. Time zone is fixed so that
# calendar parts and timestamp casts never depend on the machine.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints (dense keys, dashboard aggregates) are removed once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tripmart", extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with tripmart's defaults.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The value of ``spark.checkpoint.dir`` (or the context's checkpoint dir)
    wins. Only a local-mode session (tests, a laptop) without one gets a
    fresh folder under the system temp dir; on a cluster a missing setting
    is an error, as a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tripmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tripmart-scratch/{name}-{uuid.uuid4().hex[:12]}"


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RELEASING = threading.Lock()
_inside = [0, None]  # how many are inside, and the setting before the first


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write or count go when it ends, and not when the driver
    happens to collect its garbage, so that those of several do not add up on disk."""
    with _RELEASING:
        if not _inside[0]:
            _inside[1] = spark.conf.get(_RELEASE, None)
            spark.conf.set(_RELEASE, "true")
        _inside[0] += 1
    try:
        yield
    finally:
        with _RELEASING:
            _inside[0] -= 1
            if not _inside[0]:
                spark.conf.unset(_RELEASE) if _inside[1] is None else spark.conf.set(_RELEASE, _inside[1])


def kept(df: DataFrame, *cols: str) -> DataFrame:
    """The rows of ``df`` (``cols`` only, if given), written once as Parquet below the shared
    checkpoint folder and read from there: for frames with several readers, which would
    each make the rows anew."""
    path = scratch_path(df.sparkSession, "kept")
    with shuffles_released(df.sparkSession):
        df.select(*cols or df.columns).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so that Python file APIs can use the path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
