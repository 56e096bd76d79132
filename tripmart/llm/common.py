"""Shared column helpers of the document operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import scratch_path

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# ASCII white space as the contracts write it, for Java regular expressions.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def workers_import(spark: SparkSession) -> None:
    """Let a local session's Python workers import this package from any folder.

    On a cluster the launcher ships the package (``--py-files``)."""
    if spark.sparkContext.master.startswith("local["):
        root = str(Path(__file__).resolve().parents[2])
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A lambda variable is evaluated once per row; an expression that is
    referenced inside another lambda would be evaluated once per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, state: Column, step, kind: str, end=None, chunk: int = 64) -> Column:
    """array<kind> of all that ``step(state, item)`` gives, going through the items
    in order.

    ``step`` returns one struct (state, add) of the next state and an array to
    append; ``end(state)`` gives an array to append at last. What an ``aggregate``
    carries is copied at every step, so results are gathered inside chunks of items
    only: a first pass notes the state at the start of every chunk, a second one
    goes through each chunk from there. The work stays in proportion to the items.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def part(all_items: Column, k: Column) -> Column:
        return F.slice(all_items, k * chunk + 1, chunk)

    def found(x: Column) -> Column:
        def first(acc: Column, k: Column) -> Column:
            after = F.aggregate(part(x["items"], k), acc["state"], lambda s, i: step(s, i)["state"])
            return F.struct(after.alias("state"),
                            F.concat(acc["starts"], F.array(acc["state"])).alias("starts"))

        def second(starts: Column, k: Column) -> Column:
            def add(acc: Column, i: Column) -> Column:
                return let(step(acc["state"], i), lambda new: F.struct(
                    new["state"].alias("state"), F.concat(acc["cur"], new["add"]).alias("cur")))

            begin = F.struct(F.get(starts, k).alias("state"), none.alias("cur"))
            return F.aggregate(part(x["items"], k), begin, add, lambda acc: acc["cur"])

        chunks = F.sequence(F.lit(0), F.floor((F.size(x["items"]) - 1) / chunk).cast("int"))
        noted = F.aggregate(chunks, F.struct(
            x["state"].alias("state"), F.slice(F.array(x["state"]), 1, 0).alias("starts")), first)
        return let(noted, lambda y: F.concat(F.flatten(F.transform(
            chunks, lambda k: second(y["starts"], k))), *([end(y["state"])] if end else [])))

    return let(F.struct(items.alias("items"), state.alias("state")), lambda x: F.when(
        F.size(x["items"]) > 0, found(x)).otherwise(end(x["state"]) if end else none))


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (NULL: empty)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def n_words(text: Column) -> Column:
    """Number of words of a text, without building them where Spark can count."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE + "+")), F.lit(0)).cast("long")


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct ``_doc``, so that names of extra
    columns cannot clash with an operator's own; ``select("_doc.*")`` unpacks."""
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("_doc")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh folder below the shared checkpoint folder, removed at the end,
    also if the work fails. What is returned from inside must not read it
    any more (checkpoint it)."""
    folder = scratch_path(spark, name)
    try:
        yield folder
    finally:
        delete_path(spark, folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
