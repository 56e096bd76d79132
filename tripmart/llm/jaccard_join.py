"""Operator 6: n-gram Jaccard join by chosen paths.

A text is the set of its word ``n``-grams (hashed to 64 bits); texts of equal
sets are one node from here on. A set is embedded as ``SLOTS`` min-hash
values, its tokens (slot, value); two sets share a token with the probability
of their Jaccard similarity.

Chosen paths: in each run a bucket (first: everything) picks one token slot,
and with probability 1/4 a second one, by a hash of its own path, and splits
its sets by their values there. A pair of similarity s shares 1.25 * s of its
children on average, so at the threshold of 0.8 a similar pair keeps one
common bucket per level. After ``LEVELS`` splits small buckets are compared
by brute force. Larger ones are split further, always by two slots, so that a
pair at the threshold keeps 1.6 common buckets per level and hardly any is
lost however deep the splits go; unless their sets are similar to each other
on the whole (estimated by counting collisions at probe slots): those, and
buckets at the last level, are compared in blocks of bounded size, all
against all, so nothing is dropped. Runs are repeated until the chance that a
pair at the threshold meets, even if all its buckets go to the last level,
reaches ``recall``.

A pair may meet in several buckets. Every node carries the sorted list of
its buckets, and a pair is compared only in the first that the two share, so
links are counted once without ever listing pairs: a block returns, for each
node, its number of links and one edge of a spanning forest. Buckets with the
very same members are compared once; to be split, each goes its own way.
Similarities are computed exactly from the whole sets.

Classes are the connected components of the links (alternating large-star
and small-star steps over the spanning edges, checkpointed).

Defined results: a text with fewer than ``n`` words is the one gram of all its
words; NULL, empty and blank texts have no grams, no links and are a class of
their own; equal sets link at similarity 1; ``class_id`` is the smallest doc_id
of the class and ``n_links`` the number of other documents, copies included,
with a similarity at or above the threshold; repeated rows are copies of each
other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir

from .common import packed, scratch_folder

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
SLOTS = 128
LEVELS = 3
MAX_LEVELS = 10
SMALL = 512  # sets in a bucket that is compared whole
BLOCK_SETS, BLOCK_GRAMS = 1024, 4_000_000
SECOND = 0.25  # chance of a second slot in the first LEVELS splits; later it is 1
ALIKE = 0.5  # mean similarity from which two slots a split no longer shrink a large bucket
PROBES = 16

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def grams(text: str | None, n: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text."""
    from xxhash import xxh3_64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").split()
    if not found:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(n, len(ids))
    acc = np.full(len(ids) - n + 1, n, np.uint64)
    for k in range(n):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + ids[k:len(ids) - n + 1 + k]
    return np.unique(_mix(acc))


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL,
                levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold has met with that chance, if
    its buckets are split up to ``MAX_LEVELS`` times.

    The number of slots at which the pair agrees is binomial; the runs are
    independent only for a given number.
    """
    def meets(share: float) -> float:
        chance = 1.0
        for level in range(max(levels, MAX_LEVELS), 0, -1):
            one, second = share * chance, SECOND if level <= levels else 1.0
            chance = (1 - second) * one + second * (1 - (1 - one) ** 2)
        return chance

    chances = [(math.comb(SLOTS, k) * threshold ** k * (1 - threshold) ** (SLOTS - k),
                meets(k / SLOTS)) for k in range(SLOTS + 1)]
    if chances[0][0] > 1 - recall:
        raise ValueError(f"{SLOTS} slots do not reach a recall of {recall} at {threshold}")
    runs = 1
    while sum(p * (1 - m) ** runs for p, m in chances) > 1 - recall:
        runs += 1
    return runs


def _slots() -> tuple[np.ndarray, np.ndarray]:
    seeds = _mix(np.arange(1, 2 * SLOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:SLOTS] | np.uint64(1), seeds[SLOTS:]


def signature(found: np.ndarray, chunk: int = 512) -> np.ndarray:
    """SLOTS min-hash values (32 bits) of a non-empty set."""
    a, b = _slots()
    low = np.full(SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(found), chunk):
        low = np.minimum(low, (found[None, i:i + chunk] * a[:, None] + b[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32)


def split(paths: np.ndarray, signatures: np.ndarray,
          second: float = SECOND) -> tuple[np.ndarray, np.ndarray]:
    """One level: (row, child path) from each row's path and signature."""
    rows = np.arange(len(paths))
    choice = _mix(paths ^ np.uint64(0xA5A5A5A5A5A5A5A5))

    def child(rows: np.ndarray, pick: np.ndarray) -> np.ndarray:
        slot = (pick % np.uint64(SLOTS)).astype(np.int64)
        value = signatures[rows, slot].astype(np.uint64)
        return _mix(_mix(paths[rows] + pick) + (value << np.uint64(8)) + np.uint64(1))

    first = child(rows, choice)
    twice = rows[(choice >> np.uint64(40)) < np.uint64(int(second * (1 << 24)))]
    other = child(twice, _mix(choice[twice] + np.uint64(7)))
    return np.concatenate([rows, twice]), np.concatenate([first, other])


def first_buckets(signatures: np.ndarray, runs: int, levels: int = LEVELS) -> list[np.ndarray]:
    """Bucket ids of every row after ``levels`` splits in each run."""
    rows, paths = [], []
    for run in range(runs):
        r = np.arange(len(signatures))
        p = np.full(len(signatures), _mix(np.array([run + 1], np.uint64))[0])
        for _ in range(levels):
            at, p = split(p, signatures[r])
            r = r[at]
        rows.append(r)
        paths.append(p)
    r, p = np.concatenate(rows), np.concatenate(paths).view(np.int64)
    order = np.argsort(r, kind="stable")
    return [np.unique(x) for x in np.split(p[order], np.cumsum(np.bincount(
        r, minlength=len(signatures)))[:-1])]


def embed(docs: DataFrame, n: int, runs: int) -> DataFrame:
    """(doc_id, key, again, node, size, sig, buckets) of every document; a document
    without grams has no buckets and a node of its own id; ``key`` and ``again``
    are hashes of id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                ids, texts = part.column(0).to_pylist(), part.column(3)
                nodes, sizes, sigs = [], [], []
                for doc_id, text in zip(ids, texts):
                    found = grams(text.as_py(), n)
                    data = found.tobytes() if len(found) else b"blank" + repr(doc_id).encode()
                    nodes.append(hashlib.blake2b(data, digest_size=16).digest())
                    sizes.append(len(found))
                    sigs.append(signature(found) if len(found) else np.zeros(SLOTS, np.uint32))
                buckets = first_buckets(np.array(sigs).reshape(-1, SLOTS), runs) if ids else []
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:3], pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()),
                    pa.array([s.tobytes() for s in sigs], pa.binary()),
                    pa.array([b if k else b[:0] for k, b in zip(sizes, buckets)],
                             pa.list_(pa.int64()))],
                    ["doc_id", "key", "again", "node", "size", "sig", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_keys(), "text").mapInArrow(
        run, "doc_id long, key long, again long, node binary, size int, sig binary, "
             "buckets array<long>")


def row_keys() -> list[Column]:
    """Two hashes of a row's id and text: rows of one id may differ in text."""
    doc_id = F.col("doc_id").cast("long")
    return [F.xxhash64(doc_id, "text").alias("key"),
            F.xxhash64(F.lit("again"), doc_id, "text").alias("again")]


def shared_buckets(members: DataFrame) -> DataFrame:
    """(bucket, sets, grams, rep) of buckets with two sets or more; ``rep`` is
    the smallest id of the buckets with the same members. Of small buckets
    only that one is given; large ones may be split, each in its own way."""
    counts = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("size").alias("grams"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit("again"))).alias("y")).filter("sets > 1")
    same = counts.groupBy("sets", "grams", "x", "y").agg(
        F.min("bucket").alias("rep"),
        F.collect_list(F.when(F.col("sets") > SMALL, F.col("bucket"))).alias("all"))
    return same.select(F.explode(F.when(F.col("sets") > SMALL, F.col("all")).otherwise(
        F.array("rep"))).alias("bucket"), "sets", "grams", "rep")


def mean_similarity(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """(bucket, alike): estimated mean similarity of all pairs of a bucket:
    at a probe slot, the chance that two members have the same value."""
    probes = F.array(*[F.struct(F.lit(k).alias("slot"), F.substring(
        F.col("sig"), 4 * (k * SLOTS // PROBES) + 1, 4).alias("value")) for k in range(PROBES)])
    return members.join(sigs, "node").select("bucket", F.explode(probes).alias("p")).groupBy(
        "bucket", "p.slot", "p.value").agg(F.count(F.lit(1)).alias("c")).groupBy(
        "bucket", "slot").agg((F.sum(F.col("c") * F.col("c")) / F.pow(F.sum("c"), 2)).alias("same")
                              ).groupBy("bucket").agg(F.avg("same").alias("alike"))


def final_buckets(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """(bucket, node, size, sets, grams): the buckets to compare.

    ``members`` has rows (bucket, node, size), ``sigs`` rows (node, sig), one or
    more per node. Large dissimilar buckets are split again, level by level,
    while there are any; only the signatures of large buckets' sets move.
    """
    def resplit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.array([np.frombuffer(s.as_py(), np.uint32) for s in batch.column(3)],
                           np.uint32).reshape(-1, SLOTS)
            at, paths = split(batch.column(0).to_numpy().view(np.uint64), sig, 1.0)
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths.view(np.int64)), batch.column(1).take(at), batch.column(2).take(at)],
                ["bucket", "node", "size"])

    done = []
    for level in range(LEVELS, MAX_LEVELS + 1):
        kept = members.join(shared_buckets(members), "bucket").checkpoint()
        large = kept.filter(F.col("sets") > SMALL)
        if level == MAX_LEVELS or large.isEmpty():
            done.append(kept.filter("bucket = rep"))
            break
        nodes = large.select("node").distinct()
        sigs = sigs.join(nodes, "node", "left_semi").groupBy("node").agg(
            F.min("sig").alias("sig")).checkpoint()
        apart = mean_similarity(large.filter("bucket = rep").select("bucket", "node"), sigs).filter(
            F.col("alike") < ALIKE).select(F.col("bucket").alias("rep"))
        again = large.join(apart, "rep", "left_semi").checkpoint()
        done.append(kept.filter("bucket = rep").join(
            again.select("rep").distinct(), "rep", "left_anti"))
        if again.isEmpty():
            break
        members = again.select("bucket", "node", "size").join(sigs, "node").select(
            "bucket", "node", "size", "sig").mapInArrow(
            resplit, "bucket long, node binary, size int").dropDuplicates(["bucket", "node"])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("bucket", "node", "size", "sets", "grams")


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(group: pa.Table, threshold: float) -> pa.Table:
    """Brute force over one block pair: links per node, one edge each.

    Counts the common grams of all pairs by products of 0/1 matrices over
    the grams that two sets or more hold, some columns at a time.
    """
    group = group.sort_by([("rep", "ascending"), ("node", "ascending")])
    m, bucket = group.num_rows, group.column("bucket")[0].as_py()
    p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
    sets = [np.frombuffer(s.as_py(), np.uint64) for s in group.column("grams")]
    sizes = np.array([len(s) for s in sets])
    values, which = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    keep = times[column] > 1
    column, which = np.unique(column[keep], return_inverse=True)[1], which[keep]
    order = np.argsort(column, kind="stable")
    column, which = column[order], which[order]
    common = np.zeros((m, m), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [start, start + width])
        x = np.zeros((m, width), np.float32)
        x[which[i:j], column[i:j] - start] = 1
        common += x @ x.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * union - 1e-6
    # only pairs of this block pair that share no earlier bucket
    lists = [np.array(b.as_py(), np.int64) for b in group.column("buckets")]
    earlier = np.concatenate(lists)
    owner = np.repeat(np.arange(m), [len(b) for b in lists])
    owner, earlier = owner[earlier < bucket], earlier[earlier < bucket]
    if len(earlier):
        names, col = np.unique(earlier, return_inverse=True)
        for start in range(0, len(names), width):
            some = (col >= start) & (col < start + width)
            x = np.zeros((m, width), np.float32)
            x[owner[some], col[some] - start] = 1
            linked &= (x @ x.T) == 0
    block = group.column("block").to_numpy()
    if p != q:
        linked &= block[:, None] != block[None, :]
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(linked)
    label = _components(m, a, b)
    weight = group.column("copies").to_numpy().astype(np.float64)
    links = (linked @ weight).astype(np.int64)
    some = np.nonzero(links > 0)[0]
    nodes = group.column("node")
    return pa.table({"node": nodes.take(pa.array(some)), "links": pa.array(links[some]),
                     "root": nodes.take(pa.array(label[some]))})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of edges (a, b).

    Alternates large-star and small-star steps until nothing changes; every
    step is checkpointed. The root is the smallest node.
    """
    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        return tuple(row)

    # kept as a > b
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
                                      ).distinct().checkpoint()
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"),
                                                           F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")
                                               ).unionByName(low.select("a", F.col("m").alias("b")))
        e = small.filter("a <> b").distinct().checkpoint()
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def join_documents(docs: DataFrame, n: int = GRAM, threshold: float = THRESHOLD,
                   recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links and n_copies (documents of the same set)."""
    return classified(docs, n, threshold, recall).select(
        "doc_id", "class_id", "n_links", "n_copies")


def classified(docs: DataFrame, n: int = GRAM, threshold: float = THRESHOLD,
               recall: float = RECALL) -> DataFrame:
    """``join_documents`` with the rows' ``key`` and ``again`` and ``first``: is it the
    class's document of the smallest id (NULL last, ties by key)?"""
    spark: SparkSession = docs.sparkSession
    checkpoint_dir(spark)
    with scratch_folder(spark, "jaccard") as folder:
        embed(docs, n, runs_needed(threshold, recall)).write.parquet(folder)
        rows = spark.read.parquet(folder)
        # one row per set, of its smallest id: partial aggregation leaves one row per
        # task of any number of copies
        least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "again",
                               "size", "buckets"))
        one = rows.filter("size > 0").groupBy("node").agg(
            least.alias("m"), F.count(F.lit(1)).alias("copies")).select(
            "node", F.struct("m.none", "m.doc_id", "m.key", "m.again").alias("least"),
            F.col("m.doc_id").alias("rep"), "copies", "m.size", "m.buckets").checkpoint()
        members = one.select("node", "size", F.explode("buckets").alias("bucket"))
        placed = final_buckets(members, rows.select("node", "sig")).checkpoint()
        lists = placed.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
        active = one.select("node", "rep", "copies").join(lists, "node")
        sets = sets_of(docs, active.select("rep").distinct(), n)
        nodes = active.join(sets, "node")
        blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS))
        units = placed.select("bucket", "node", blocks.alias("blocks")).withColumn(
            "block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
            "bucket", "node", "block", F.least("block", "other").alias("p"),
            F.greatest("block", "other").alias("q"))
        found = units.join(nodes, "node").groupBy("bucket", "p", "q").applyInArrow(
            lambda t: compare(t, threshold), "node binary, links long, root binary").checkpoint()
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
        classes = one.select("node", "least", "copies").join(roots, "node", "left").join(
            links, "node", "left").withColumn("root", F.coalesce("root", "node"))
        first = classes.groupBy("root").agg(F.min("least").alias("of_class"))
        classes = classes.join(first, "root").select(
            "node", "of_class", "copies", F.coalesce("links", F.lit(0)).alias("links"))
        blank = rows.filter("size = 0").select(
            "doc_id", "key", "again", F.col("doc_id").alias("class_id"),
            F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"),
            F.lit(True).alias("first"))
        is_first = (F.col("of_class.key") == F.col("key")) & (F.col("of_class.again") == F.col("again"))
        return rows.filter("size > 0").select("doc_id", "key", "again", "node").join(
            classes, "node").select(
            "doc_id", "key", "again", F.col("of_class.doc_id").alias("class_id"),
            (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
            F.col("copies").cast("long").alias("n_copies"), is_first.alias("first")
        ).unionByName(blank).checkpoint()


def sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(node, grams) of the documents in ``ids`` (column rep), grams as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams(t.as_py(), n).tobytes() for t in batch.column(0)]
            nodes = [hashlib.blake2b(f, digest_size=16).digest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(found, pa.binary())], ["node", "grams"])

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        ids, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi").select("text")
    return some.mapInArrow(run, "node binary, grams binary").dropDuplicates(["node"])


def keep_one(docs: DataFrame, n: int = GRAM, threshold: float = THRESHOLD,
             recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class: the one of the smallest id.

    Rows are matched by hashes of id and text, so of two rows with one id only
    the chosen one stays; of rows repeated as a whole one stays. The texts are
    shuffled once: the join and the removal of repeats use the same keys."""
    kept = classified(docs, n, threshold, recall).filter("first").select(
        F.col("key").alias("_key"), F.col("again").alias("_again"))
    key, again = row_keys()
    rows = docs.select(packed(docs), key.alias("_key"), again.alias("_again"))
    return rows.join(kept.hint("merge"), ["_key", "_again"], "left_semi").dropDuplicates(
        ["_key", "_again"]).select("_doc.*")
