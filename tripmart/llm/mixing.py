"""Operator 8: mixing sources to target weights along a time-varying curriculum.

Sizes are words. Sources, in code-point order (NULL last), take the weights
5, 2, 1 in turn and share ``share`` times all words; a source takes at most
``repeats`` times its own size, and what it cannot take goes to the others by
weight. With the sources sorted by cap / weight the final share of one weight
unit is the largest of the levels (demand - caps before) / (weights from
here), so the resharing needs one pass over the (small) table of sources.

Inside a source the documents follow the order of a hash of their id, with
running sums of words. Pass k over the source puts a document at words
``k * source_size + words before it``; the mix takes it while its middle lies
within the source's target, so a source ends within half a document of it.
Each source has a weight schedule over training time 0..1. Its integral is
the source's cumulative demand; inverting it at a document's middle gives
the training position, and the result is range-sorted by position.

A source may hold any part of all rows: the running sums are taken per
(source, hash bucket) and shifted by the sums of the buckets before, so one
task holds one bucket of one source, and only (id, source, size, hash) rows
move. A bucket is a prefix of the hash, as long as it takes for about
``BUCKET_ROWS`` rows; its length changes no result. Rows without an id are hashed
by their text, so they spread like any others; only rows repeated as a whole, id
and text, stay together.

Defined results: a NULL text has size 0 and is never taken; NULL is a source
of its own; repeated rows are documents of their own (equal ones change
places freely); a source without words has target 0; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir

from .common import n_words, packed

WEIGHTS = (5, 2, 1)
BUCKET_ROWS = 100_000
SHARE = 1.5
REPEATS = 2
# weight -> knots (time, relative weight) of a piecewise linear schedule:
# heavy sources lead, light ones are kept for the end of the training
SCHEDULES: dict[int, Sequence[tuple[float, float]]] = {
    5: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    2: ((0.0, 1.0), (1.0, 1.0)),
    1: ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
}


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            repeats: int = REPEATS) -> DataFrame:
    """(source, weight, source_size, target) from rows (source, size).

    The windows without a partition run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", (F.col("source_size") * repeats).cast("double"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    demand = F.sum("source_size").over(everything) * share
    caps_before = F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before),
                                                                 F.lit(0))
    per = per.withColumn("_level", (demand - caps_before) / weights_left)
    level = F.max("_level").over(everything)
    return per.withColumn("target", F.least(F.col("weight") * level, F.col("_cap"))).select(
        "source", "weight", "source_size", "target")


def invert_schedule(part: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the schedule's integral reaches ``part`` of its whole."""
    spans = list(zip(knots, knots[1:]))
    areas = [(w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in spans]
    out, done = None, sum(areas)
    for ((t0, w0), (t1, w1)), area in reversed(list(zip(spans, areas))):
        done -= area
        rest = part * sum(areas) - done  # words of this span already asked for
        slope = (w1 - w0) / (t1 - t0)
        root = F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + rest * (2 * slope), F.lit(0.0)))
        here = F.when(root > 0, F.lit(t0) + rest * 2 / root).otherwise(F.lit(t0))
        out = here if out is None else F.when(part * sum(areas) < done + area, here).otherwise(out)
    return F.round(F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0)), 6)


def position_of(weights: Sequence[int], schedules: dict, part: Column) -> Column:
    """Training time of ``part`` of a source's demand, by the source's ``weight``."""
    when = F.lit(None).cast("double")
    for weight in dict.fromkeys(weights):
        when = F.when(F.col("weight") == weight,
                      invert_schedule(part, schedules[weight])).otherwise(when)
    return when


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        repeats: int = REPEATS, schedules: dict = SCHEDULES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and the
    training positions ``position`` (NULL: not taken) and ``positions`` (one per
    time it is taken). Sorted by position over all partitions."""
    return placed_rows(docs, weights, share, repeats, schedules).drop("_key", "_again").orderBy(
        F.col("position").asc_nulls_last(), "doc_id")


def row_keys() -> list[Column]:
    """Two hashes of a row's id and text."""
    return [F.xxhash64("doc_id", "text").alias("_key"),
            F.xxhash64(F.lit("again"), F.col("doc_id"), F.col("text")).alias("_again")]


def placed_rows(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                repeats: int = REPEATS, schedules: dict = SCHEDULES) -> DataFrame:
    """The rows of ``mix``, in no order, with the ``row_keys`` of each."""
    checkpoint_dir(docs.sparkSession)
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(
        F.lit("no id "), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    # written once: texts are read and counted a single time
    sized = docs.select("doc_id", F.col("source").alias("source"), n_words(F.col("text")).alias("size"),
                        F.md5(name).alias("_hash"), *row_keys()).checkpoint()
    n, digits = sized.count(), 2
    while 16 ** digits * BUCKET_ROWS < n:
        digits += 1
    sized = sized.withColumn("_bucket", F.substring("_hash", 1, digits))
    buckets = sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_offset", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    plan = targets(sized.select("source", "size"), weights, share, repeats)
    offsets = offsets.alias("o").join(plan.alias("p"), F.expr("o.source <=> p.source")).select(
        F.col("o.source").alias("_source"), F.col("o._bucket").alias("_in"), "_offset", "weight",
        "source_size", "target")
    placed = sized.join(offsets, F.expr("source <=> _source AND _bucket = _in"))
    inside = Window.partitionBy("_source", "_in").orderBy("_hash", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = placed.withColumn("_at", F.col("_offset") + F.coalesce(
        F.sum("size").over(inside), F.lit(0)))
    middle = F.col("_at") + F.col("size") / 2
    passes = [middle + F.col("source_size") * k for k in range(repeats)]
    asked = F.array(*[F.when((F.col("size") > 0) & (p <= F.col("target")), p / F.col("target"))
                      for p in passes])
    placed = placed.withColumn("positions", F.transform(
        F.array_compact(asked), lambda x: position_of(weights, schedules, x)))
    return placed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.size("positions")).alias("taken"),
        F.get("positions", F.lit(0)).alias("position"), "positions", "_key", "_again")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a document that is taken twice comes
    twice, one that is not taken is gone; sorted by training position.

    Rows are matched by hashes of id and text; rows repeated as a whole share the
    list of their plans and take them in turn, so the join multiplies none.
    """
    keys = ["_key", "_again"]
    plan = placed_rows(docs, **options).groupBy(*keys).agg(
        F.sort_array(F.collect_list("positions")).alias("_plans"))
    rows = docs.select(packed(docs), *row_keys())
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    placed = rows.join(plan, keys).withColumn("_plan", F.element_at("_plans", nth)).select(
        "_doc", F.explode("_plan").alias("_position"))
    return placed.orderBy("_position", "_doc.doc_id").select("_doc.*")
