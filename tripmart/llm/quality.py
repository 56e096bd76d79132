"""Operator 3: quality rules with cross-document line frequency.

Inside each row: word and symbol counts, repeated lines, and the words that
lie in a three-word window found twice or more. Across documents: the lines
of every document are normalised (ASCII white space stripped and collapsed,
lower case, digits as 0) and hashed together with the document's host
(``source``); the distinct documents per (host, line) are counted; lines in more
than ``max_docs`` documents of a host are boilerplate, and a document that would
keep less than ``min_left`` of its words without them is depleted and not kept.
``clean`` removes those lines and the documents that are not kept.

By default documents of equal text count once, so that a clean text is not taken
for boilerplate because it was copied (copies are the business of the
near-duplicate join); ``copies=True`` counts every row.

Texts are read once: counts and line hashes of every row are checkpointed
(about 20 bytes a line), and only (row, hash, words) rows are shuffled. A
line may stand in any number of documents: distinct counts are partial before
they move, and the join back is a shuffled join that AQE splits.

Defined results: a NULL text has no words (and one empty line, which is not
counted); NULL is a host of its own; repeated rows get equal results, and
count as one document for line frequency; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir

from .common import NOT_SPACE, SPACE, let, packed, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_DOCS = 20  # documents of one host that may share a line
MIN_LEFT = 0.5  # part of its words a document must keep

SYMBOLS = r"[#*$%&|<>]"


def repeated_window_words(tokens: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words found twice or more.

    Windows are hashed, sorted by (hash, position) and compared with their
    neighbours: n log n inside the row, no pairs.
    """
    def covered(marked: Column) -> Column:
        # positions ascend: every window adds the words its predecessor left out
        return F.aggregate(
            marked, F.struct(F.lit(-window).alias("at"), F.lit(0).alias("n")),
            lambda acc, at: F.struct(at.alias("at"), (
                acc["n"] + F.least(F.lit(window), at - acc["at"])).alias("n")),
            lambda acc: acc["n"])

    def twice(found: Column) -> Column:
        hit = F.filter(found, lambda x, i: (F.get(found, i - 1)["h"].eqNullSafe(x["h"]))
                       | (F.get(found, i + 1)["h"].eqNullSafe(x["h"])))
        return covered(F.array_sort(F.transform(hit, lambda x: x["i"])))

    def windows(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - window),
            lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(window)]).alias("h"),
                               i.alias("i")))
        return F.when(F.size(w) < window, F.lit(0)).otherwise(let(F.sort_array(hashes), twice))

    return let(tokens, windows)


def normal_line(line: Column) -> Column:
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.lower(F.regexp_replace(F.regexp_replace(bare, SPACE + "+", " "), "[0-9]", "0"))


def measures(docs: DataFrame, *more: Column) -> DataFrame:
    """Per-row counts, text hash and the hashed lines (h, w words each)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    per_row = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        let(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_window_words(w).cast("long").alias("n_repeat_words"))).alias("_w"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")
            ).alias("n_dup_lines"),
        F.xxhash64(text).alias("_text"),
        F.transform(lines, lambda line: F.struct(
            F.xxhash64(F.col("source"), normal_line(line)).alias("h"),
            F.regexp_count(line, F.lit(NOT_SPACE + "+")).alias("w"))).alias("_lines"), *more)
    return per_row.select("_row", "doc_id", "_w.n_words", "_w.word_chars", "n_symbols", "n_dup_lines",
                          "_w.n_repeat_words", "_text", "_lines", *(["_doc"] if more else []))


def _heavy(base: DataFrame, max_docs: int, copies: bool) -> DataFrame:
    """(h): lines in more than ``max_docs`` documents of a host, checkpointed, so that
    a join with them is shuffled and AQE can split a line of very many documents."""
    lines = base.select("_row", "_text", F.explode("_lines.h").alias("h"))
    return lines.groupBy("h").agg(F.countDistinct("_row" if copies else "_text").alias("_docs")).filter(
        F.col("_docs") > max_docs).select("h").checkpoint()


def _verdict(base: DataFrame, heavy: DataFrame, min_left: float, *more: str) -> DataFrame:
    gone = base.select("_row", F.explode("_lines").alias("line")).select(
        "_row", "line.h", "line.w").join(heavy, "h").groupBy("_row").agg(
        F.sum("w").cast("long").alias("n_boilerplate_words"), F.collect_set("h").alias("_drop"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    removed = F.coalesce(F.col("n_boilerplate_words"), F.lit(0)).cast("long")
    left = F.col("n_words") - removed
    return base.drop("_lines", "_text").join(gone, "_row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (left >= F.col("n_words") * min_left)).alias("kept"),
        removed.alias("n_boilerplate_words"), *more)


def judge(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT,
          copies: bool = False) -> DataFrame:
    """doc_id, the counts, base_failed, kept and ``n_boilerplate_words``."""
    checkpoint_dir(docs.sparkSession)
    base = measures(docs).checkpoint()
    return _verdict(base, _heavy(base, max_docs, copies), min_left)


def clean(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT,
          copies: bool = False) -> DataFrame:
    """The kept ``docs`` with the boilerplate lines removed from ``text`` (NULL is
    never kept) and ``n_chars``, where there is one, set to the new length."""
    checkpoint_dir(docs.sparkSession)
    # rows travel with their measures: numbers of rows must not be made twice
    base = measures(docs, packed(docs)).checkpoint()
    found = _verdict(base, _heavy(base, max_docs, copies), min_left, "_doc", "_drop").filter("kept")
    lines = F.split(F.col("_doc.text"), "\n")
    stays = F.when(F.col("_drop").isNull(), lines).otherwise(F.filter(lines, lambda line: ~(
        line.rlike(NOT_SPACE) & F.array_contains(F.col("_drop"), F.xxhash64(
            F.col("_doc.source"), normal_line(line))))))
    new = found.select("_doc", F.array_join(stays, "\n").alias("_new"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_new").alias(name)
        if name == "n_chars":
            return F.length("_new").cast("long").alias(name)
        return F.col("_doc")[name].alias(name)

    return new.select(*[column(c) for c in docs.columns])
