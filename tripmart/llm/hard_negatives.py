"""Operator 12: hard-negative mining by matrix products in a residue number system.

Every component x becomes the integer floor(256 * x). Scores are inner
products of integers, and exact: vectors are reduced modulo several small
primes to balanced residues, the residue matrices are multiplied in float32
(all partial sums stay below 2^24, where float32 is exact; longer vectors are
multiplied in pieces), and the signed scores come back by Chinese remaindering
with balanced mixed-radix digits. As many primes are taken as the largest
possible score asks for.

An anchor's positives are its ``K`` best rows of the same label; for each of
them the negatives are the ``K`` best rows of other labels inside a window of
scores below the positive's. Both passes hold the stated anchors against all
rows, in blocks: anchors are dealt to blocks of at most ``ANCHORS``, rows to
stripes by a hash of their place (so no vector, label or id can be hot), and a
cell is one block against one stripe. A task sorts its cell's anchors before
its rows and streams the rows past them, so it holds one block of anchors,
``ROWS`` rows and ``K`` best rows an anchor (or window). A cell returns those
best rows, and a window over them gives the final ones; nothing is collected
but four numbers of the whole table.

Defined results: rows with a NULL id, a NULL label, a NULL vector or a NULL or
non-finite component take no part; components that a shorter vector lacks are
zero; rows with the anchor's own id are neither its positives nor its
negatives; of equal anchor rows one counts, all other repeated rows count
each; an anchor without a positive, or a positive without a row in its
window, has no result row; ties go to the smaller id; an empty table gives
an empty result; other columns are ignored. Vectors so large that a score
times 100 does not fit in a long raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

SCALE = 256
K = 5
LOW_PART, WHOLE = 80, 100  # window: LOW_PART * positive <= WHOLE * negative <= WHOLE * positive
ANCHORS = 1024  # in a block
ROWS = 1024  # rows multiplied at once
MOST_CELLS = 20_000  # partitions at most; more cells share partitions, one after another
_NONE = np.iinfo(np.int64).min


def primes_for(bound: int, below: int = 256) -> list[int]:
    """The largest odd primes below ``below`` whose product exceeds 2 * ``bound`` + 1."""
    found, product = [], 1
    for n in range(below - 1, 2, -1):
        if product > 2 * bound + 1:
            break
        if all(n % d for d in range(2, int(n ** 0.5) + 1)):
            found.append(n)
            product *= n
    if product <= 2 * bound + 1:
        raise ValueError(f"no primes below {below} for scores up to {bound}")
    return found


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Remainders of ``x`` modulo ``p`` from -(p - 1) / 2 to (p - 1) / 2."""
    half = (p - 1) // 2
    return (x + half) % p - half


class Residues:
    """Integer vectors as float32 matrices of balanced residues, one per prime."""

    def __init__(self, vectors: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [_balanced(vectors, p).astype(np.float32) for p in primes]

    def rows(self, start: int, end: int) -> Residues:
        out = Residues.__new__(Residues)
        out.primes, out.parts = self.primes, [x[start:end] for x in self.parts]
        return out

    def __matmul__(self, other: Residues) -> np.ndarray:
        """Exact inner products (int64) of all own rows with all rows of ``other``."""
        remainders = []
        for p, a, b in zip(self.primes, self.parts, other.parts):
            width = (1 << 24) // ((p - 1) // 2) ** 2  # exact in float32 whatever the order
            total = np.zeros((len(a), len(b)), np.int64)
            for at in range(0, a.shape[1], width):
                total += (a[:, at:at + width] @ b[:, at:at + width].T).astype(np.int64)
            remainders.append(_balanced(total, p))
        return from_remainders(remainders, self.primes)


def from_remainders(remainders: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed integers from their remainders: balanced mixed-radix digits."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        digit = remainders[i]
        for j, d in enumerate(digits):
            digit = _balanced((digit - d) * pow(primes[j], -1, p), p)
        digits.append(digit)
    value = digits[-1]
    for p, d in zip(reversed(primes[:-1]), reversed(digits[:-1])):
        value = value * p + d
    return value


def quantised(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * x) of every component, rows padded with zeros to ``dims``."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), dims), np.int64)
    whole = np.floor(SCALE * flat).astype(np.int64)
    if len(sizes) and (sizes == dims).all():
        return whole.reshape(len(vectors), dims)
    out[np.arange(dims)[None, :] < sizes[:, None]] = whole
    return out


def first_best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Mask of each row's ``k`` largest allowed scores; of equal ones the first."""
    held = np.where(allowed, scores, _NONE)
    if held.shape[1] <= k:
        return held > _NONE
    least = np.partition(held, -k, axis=1)[:, -k, None]
    above, equal = held > least, (held == least) & (held > _NONE)
    return above | (equal & (equal.cumsum(axis=1) <= k - above.sum(axis=1, keepdims=True)))


class Best:
    """The ``k`` best (score, id) of ``n`` rankings, fed in the order of ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((n, k), _NONE), np.zeros((n, k), np.int64)

    def feed(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray,
             which: np.ndarray | None = None) -> None:
        """``which``: the rankings that the rows of ``scores`` belong to."""
        which = np.arange(len(self.scores)) if which is None else which
        least = self.scores[which, -1, None]  # only what beats the last one can enter
        allowed = allowed & ((scores > least) | (least == _NONE))
        some = np.nonzero(allowed.any(axis=1))[0]
        if not len(some):
            return
        row, col = np.nonzero(first_best(scores[some], allowed[some], self.k))
        place = np.arange(len(row)) - np.searchsorted(row, row)
        new, ids_new = np.full((len(some), self.k), _NONE), np.zeros((len(some), self.k), np.int64)
        new[row, place], ids_new[row, place] = scores[some][row, col], ids[col]
        at = which[some]
        both = np.concatenate([self.scores[at], new], axis=1)
        both_ids = np.concatenate([self.ids[at], ids_new], axis=1)
        order = np.argsort(~both, axis=1, kind="stable")[:, :self.k]  # descending, no overflow
        self.scores[at] = np.take_along_axis(both, order, axis=1)
        self.ids[at] = np.take_along_axis(both_ids, order, axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part."""
    v = F.col("embedding")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double")) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long")
                          .alias("label"), v).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & good)


def _cells(rows: DataFrame, anchors: DataFrame, blocks: int, stripes: int) -> DataFrame:
    """Anchors before rows, by id, in every cell; a partition holds whole cells."""
    row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(stripes))
    block = F.pmod(F.col("anchor_key"), F.lit(blocks))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    none = F.lit(None)
    both = anchors.withColumn("_stripe", upto(stripes)).select(
        (block * stripes + F.col("_stripe")).alias("cell"), F.lit(0).alias("kind"), "vec_id",
        "label", "embedding", "anchor_key", "positives").unionByName(
        rows.select("*", row.alias("_stripe")).withColumn("_block", upto(blocks)).select(
            (F.col("_block") * stripes + F.col("_stripe")).alias("cell"), F.lit(1).alias("kind"),
            "vec_id", "label", "embedding", none.cast("long").alias("anchor_key"),
            none.cast("array<struct<score:bigint,id:bigint>>").alias("positives")))
    parts = min(blocks * stripes, max(MOST_CELLS, shuffle_partitions(rows.sparkSession)))
    return both.repartitionById(parts, (F.col("cell") % parts).cast("int")).sortWithinPartitions(
        "cell", "kind", "vec_id")


class _Block:
    """Anchors of one cell with the rankings of one pass."""

    def __init__(self, batch: pa.RecordBatch, dims: int, primes: list[int]):
        take = lambda name: batch.column(batch.schema.get_field_index(name))
        self.keys, self.ids, self.labels = (take(c).to_numpy() for c in
                                            ("anchor_key", "vec_id", "label"))
        self.vectors = Residues(quantised(take("embedding"), dims), primes)
        self.positives = take("positives").to_pylist()

    def feed(self, ids: np.ndarray, labels: np.ndarray, vectors: Residues) -> None:
        for at in range(0, len(ids), ROWS):
            end = min(at + ROWS, len(ids))
            self.rank(self.vectors @ vectors.rows(at, end), ids[at:end], labels[at:end])

    def rank(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        raise NotImplementedError

    def out(self) -> pa.RecordBatch:
        raise NotImplementedError


class _Positives(_Block):
    schema = "anchor_key long, anchor_id long, score long, id long"

    def __init__(self, batch, dims, primes):
        super().__init__(batch, dims, primes)
        self.best = Best(len(self.ids), K)

    def rank(self, scores, ids, labels):
        self.best.feed(scores, (self.labels[:, None] == labels) & (self.ids[:, None] != ids), ids)

    def out(self):
        i, j = np.nonzero(self.best.scores > _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.keys[i], self.ids[i], self.best.scores[i, j],
                                   self.best.ids[i, j])], ["anchor_key", "anchor_id", "score", "id"])


class _Negatives(_Block):
    schema = ("anchor_key long, anchor_id long, place long, positive_id long, "
              "positive_score long, score long, id long")

    def __init__(self, batch, dims, primes):
        super().__init__(batch, dims, primes)
        found = [(i, place, p["score"], p["id"]) for i, ps in enumerate(self.positives)
                 for place, p in enumerate(ps)]
        self.owner, self.place, self.high, self.positive = (
            np.array([f[c] for f in found], np.int64) for c in range(4))
        self.low = -((-LOW_PART * self.high) // WHOLE)  # the least integer inside the window
        self.best = Best(len(found), K)

    def rank(self, scores, ids, labels):
        for place in range(K):
            at = np.nonzero(self.place == place)[0]
            own = scores[self.owner[at]]
            other = (self.labels[self.owner[at], None] != labels) & (self.ids[self.owner[at], None] != ids)
            self.best.feed(own, other & (own <= self.high[at, None]) & (own >= self.low[at, None]),
                           ids, at)

    def out(self):
        i, j = np.nonzero(self.best.scores > _NONE)
        owner = self.owner[i]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.keys[owner], self.ids[owner], self.place[i],
                                   self.positive[i], self.high[i], self.best.scores[i, j],
                                   self.best.ids[i, j])],
            [c.split()[0] for c in self.schema.split(", ")])


def _streamed(cells: DataFrame, block: type[_Block], dims: int, primes: list[int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            tags = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            cuts = [0, *(np.nonzero(np.diff(tags))[0] + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                part, here, is_row = batch.slice(a, b - a), int(tags[a]) // 2, int(tags[a]) % 2
                if here != cell:
                    if held is not None:
                        yield held.out()
                    cell, anchors, held = here, [], None
                if not is_row:
                    anchors.append(part)
                elif anchors:
                    if held is None:
                        whole = pa.Table.from_batches(anchors).combine_chunks().to_batches()[0]
                        held = block(whole, dims, primes)
                    held.feed(part.column(2).to_numpy(), part.column(3).to_numpy(),
                              Residues(quantised(part.column(4), dims), primes))
        if held is not None:
            yield held.out()

    return cells.mapInArrow(run, block.schema)


def mine(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` is a condition
    on them that says which rows are anchors."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    key = F.xxhash64("vec_id", "label", "embedding").alias("anchor_key")
    anchors = rows.filter(is_anchor).select("*", key).dropDuplicates(["anchor_key"])
    size = F.coalesce(F.array_max(F.transform("embedding", lambda x: F.abs(SCALE * x.cast("double")))),
                      F.lit(0.0))
    stats = rows.agg(F.max(size).alias("largest"), F.max(F.size("embedding")).alias("dims"),
                     F.count_if(is_anchor).alias("anchors")).first()
    dims, largest = int(stats["dims"] or 0), float(stats["largest"] or 0.0)
    bound = dims * (ceil(min(largest, 2.0 ** 40)) + 1) ** 2
    if bound * WHOLE >= 1 << 63:
        raise ValueError("scores of these vectors do not fit in a long")
    if not dims or not stats["anchors"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, "
                                         "negative_id long, positive_score long, negative_score long")
    primes = primes_for(bound)
    blocks = -(-stats["anchors"] // ANCHORS) + (0 if stats["anchors"] <= ANCHORS else 1)
    stripes = max(1, -(-shuffle_partitions(spark) // blocks))
    no_positives = F.lit(None).cast("array<struct<score:bigint,id:bigint>>").alias("positives")
    found = _streamed(_cells(rows, anchors.select("*", no_positives), blocks, stripes),
                      _Positives, dims, primes)
    by_score = [F.col("score").desc(), F.col("id")]
    top = found.withColumn("_n", F.row_number().over(Window.partitionBy("anchor_key").orderBy(
        *by_score))).filter(F.col("_n") <= K)
    lists = top.groupBy("anchor_key").agg(F.sort_array(F.collect_list(  # K at most
        F.struct("_n", F.struct("score", "id").alias("p")))).alias("l")).select(
        "anchor_key", F.col("l.p").alias("positives"))
    found = _streamed(_cells(rows, anchors.join(lists, "anchor_key"), blocks, stripes),
                      _Negatives, dims, primes)
    rank = F.row_number().over(Window.partitionBy("anchor_key", "place").orderBy(*by_score))
    return found.withColumn("rank", rank).filter(F.col("rank") <= K).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
