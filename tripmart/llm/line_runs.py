"""Operator 5: corpus-wide line dedup over levelled sorted runs.

A line's key is the line without ASCII white space at its ends and with A-Z
in lower case. How many documents hold a key is kept in runs: tables of
(key hash, documents), bucketed and sorted by the hash, all with the same
buckets. Every batch of documents is counted, merge-anti-joined with the runs
(a key that a run already shows in ``min_docs`` documents needs no further
counting) and written as a run of level 0; whenever two runs share a level
they are compacted into one of the next level by a merge of equal buckets, as
in a binary counter. Runs meet bucket by bucket, so no merge shuffles.

The keys over the limit then go back to the documents that hold them: each
document meets the (distinct) hashes of its own dropped lines, and lines are
filtered inside the row. A key may stand in any number of documents: counts
are partial before they move, and the join back is an ordinary shuffled join
that AQE splits at a hot key.

Hashes are MD5 (128 bits); two keys are taken as equal if their hashes are.

Defined results: a NULL or empty text is one empty line; empty keys are never
dropped; every row counts as a document, repeated rows too; a line that
occurs twice in a document counts once; an empty table gives an empty result;
other columns are ignored by ``dedup_lines`` and kept by ``drop_lines``, whatever
their names.
"""

from __future__ import annotations

import uuid
from contextlib import closing

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir, scratch_path

from .common import delete_path, let, packed, scratch_folder, shuffle_partitions

MIN_DOCS = 10
BATCHES = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """Stripped, ASCII lower case; for pure ASCII lines ``lower`` is the same."""
    bare = F.btrim(line, F.lit(_SPACES))
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, _UPPER, _LOWER))


def key_hash(key: Column) -> Column:
    """16 bytes of a non-empty key; NULL for the empty key."""
    return F.when(key != "", F.unhex(F.md5(key)))


def line_hashes(text: Column) -> Column:
    return F.transform(lines_of(text), lambda line: let(line_key(line), key_hash))


def distinct(values: Column) -> Column:
    """Sorted distinct values: n log n for any type, binary too."""
    return let(F.sort_array(values), lambda v: F.filter(
        v, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(v, i - 1))))


def without(lines: Column, drop: Column) -> Column:
    """``lines`` but those whose hash is in ``drop`` (distinct): both are sorted by
    hash and meet as neighbours, so the work is n log n in the lines of a text."""
    def found(line: Column, i: Column) -> Column:
        return F.struct(let(line_key(line), key_hash).alias("h"), i.alias("i"))

    def places(hit: Column, u: Column) -> Column:  # of the groups that are hit
        return F.sort_array(F.flatten(F.transform(hit, lambda g: F.transform(
            F.slice(u, g["a"] + 1, g["b"] - g["a"]), lambda x: x["i"]))))

    def of_sorted(u: Column) -> Column:
        def groups(heads: Column) -> Column:  # of equal hashes, by where they start
            marks = F.transform(drop, lambda h: F.struct(
                h.alias("h"), F.lit(0).alias("kind"), F.lit(0).alias("a"), F.lit(0).alias("b")))
            own = F.transform(heads, lambda k, j: F.struct(
                F.get(u, k)["h"].alias("h"), F.lit(1).alias("kind"), k.alias("a"),
                F.coalesce(F.get(heads, j + 1), F.size(u)).alias("b")))
            return F.sort_array(F.concat(own, marks))

        heads = F.filter(F.sequence(F.lit(0), F.size(u) - 1), lambda k: (k == 0) | (
            F.get(u, k)["h"] != F.get(u, k - 1)["h"]))
        return let(let(heads, groups), lambda c: places(F.filter(
            c, lambda x, j: (x["kind"] == 1) & F.coalesce(F.get(c, j - 1)["h"] == x["h"], F.lit(False))), u))

    def between(x: Column) -> Column:  # the stretches between dropped places
        before = lambda j: F.coalesce(F.get(x["at"], j - 1), F.lit(-1))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["at"])), lambda j: F.slice(
            x["lines"], before(j) + 2,
            F.coalesce(F.get(x["at"], j), F.size(x["lines"])) - before(j) - 1)))

    def dropped(all_lines: Column) -> Column:
        keyed = F.sort_array(F.filter(F.transform(all_lines, found), lambda x: x["h"].isNotNull()))
        at = let(keyed, lambda u: F.when(F.size(u) > 0, of_sorted(u)).otherwise(
            F.expr("cast(array() as array<int>)")))
        return let(F.struct(all_lines.alias("lines"), at.alias("at")), between)

    return let(lines, dropped)


class LineRuns:
    """Levelled runs of (h, n): in how many documents a key hash was seen."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = shuffle_partitions(spark)
        self.folder = scratch_path(spark, "line-runs")
        self.runs: list[tuple[int, str]] = []  # (level, table), oldest first

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        rows.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h") \
            .option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.runs.append((level, name))

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, f"{self.folder}/{name}")

    def _merged(self, a: str, b: str) -> DataFrame:
        left, right = self.spark.table(a).alias("a"), self.spark.table(b).alias("b")
        return left.hint("merge").join(right, F.col("a.h") == F.col("b.h"), "full_outer").select(
            F.coalesce("a.h", "b.h").alias("h"),
            (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"))

    def add(self, hashes: DataFrame) -> None:
        """Add a batch: rows (h), one for each key of each document."""
        new = hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        for _, name in self.runs:
            settled = self.spark.table(name).filter(F.col("n") >= self.min_docs).select("h")
            new = new.join(settled.hint("merge"), "h", "left_anti")
        self._write(new, 0)
        while len(self.runs) > 1 and self.runs[-1][0] == self.runs[-2][0]:
            self.compact()

    def compact(self) -> None:
        """Merge the two youngest runs into one of the next level."""
        (level, a), (other, b) = self.runs[-2:]
        del self.runs[-2:]
        self._write(self._merged(a, b), max(level, other) + 1)
        self._drop(a)
        self._drop(b)

    def heavy(self) -> DataFrame:
        """Hashes in ``min_docs`` documents or more, over all runs."""
        while len(self.runs) > 1:
            self.compact()
        return self.spark.table(self.runs[0][1]).filter(
            F.col("n") >= self.min_docs).select("h")

    def close(self) -> None:
        for _, name in self.runs:
            self._drop(name)
        self.runs = []
        delete_path(self.spark, self.folder)


def dropped_hashes(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(_id, _drop): for each doc_id with such lines, the hashes to drop."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    hashes = distinct(F.filter(line_hashes(F.col("text")), lambda h: h.isNotNull()))
    with scratch_folder(spark, "line-hashes") as folder, closing(
            LineRuns(spark, min_docs)) as runs:
        docs.select(F.col("doc_id").cast("long").alias("_id"), hashes.alias("hs")).select(
            "_id", F.explode("hs").alias("h"),
            F.pmod(F.xxhash64("_id"), F.lit(batches)).alias("batch"),
        ).write.partitionBy("batch").parquet(folder)
        held = spark.read.schema("_id long, h binary, batch long").parquet(folder)
        for batch in range(batches):
            runs.add(held.filter(F.col("batch") == batch).select("h"))
        # checkpointed, the keys are no bucketed table any more: both sides of the join
        # are shuffled, and AQE can split a key that very many documents hold
        return held.join(runs.heavy().checkpoint(), "h").groupBy("_id").agg(
            F.collect_set("h").alias("_drop")).checkpoint()


def with_dropped(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(_doc, _text, _kept, _n): rows as structs, their text, the array of
    remaining lines and the number of lines before."""
    found = dropped_hashes(docs, min_docs, batches)
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("_key"),
                       F.col("text").alias("_text"))
    joined = rows.join(found, F.col("_key").eqNullSafe(F.col("_id")), "left")
    lines = lines_of(F.col("_text"))
    stays = F.when(F.col("_drop").isNull(), lines).otherwise(without(lines, F.col("_drop")))
    return joined.select("_doc", "_text", stays.alias("_kept"), F.size(lines).alias("_n"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped and the remaining ``text``."""
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_dropped(some, min_docs, batches).select(
        "_doc.doc_id", F.col("_n").cast("long").alias("n_lines"),
        (F.col("_n") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.array_join("_kept", "\n").alias("text"))


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the lines removed from ``text`` (NULL stays NULL) and
    ``n_chars``, where there is one, set to the new length."""
    text = F.when(F.col("_text").isNotNull(), F.array_join("_kept", "\n"))
    held = with_dropped(docs, min_docs, batches).select("_doc", text.alias("_new"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_new").alias(name)
        if name == "n_chars":
            return F.length("_new").cast("long").alias(name)
        return F.col("_doc")[name].alias(name)

    return held.select(*[column(c) for c in docs.columns])
