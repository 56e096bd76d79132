"""Operator 2: document fingerprints by a randomised edit embedding.

A shared random walk reads a text: at step j it writes the character under
its head, and moves on or stays as a random function of (j, character)
decides. Texts that differ by few edits are soon read in step again, so their
edit distance becomes Hamming distance between the written strings (about two
steps a character). The random function repeats after ``PERIOD`` steps, which
makes the walk a finite automaton: one table look-up per character gives the
step at which each character is left.

The fingerprint samples the written string at shared random steps: step p
has a random level, a fingerprint of level l keeps the steps whose level is
at least l, and l is chosen by length so that 128 to 256 characters (one
hashed byte each) remain. Levels are nested, so fingerprints of different
levels are compared at the coarser one: likeness is the part of sampled steps
(of the longer walk) at which both wrote the same.

Banding: ``BANDS`` groups of ``ROWS`` sampled steps, drawn from the whole walk,
hash to keys; documents
that share a key are candidates, and verification compares the whole
fingerprints. Over a corpus equal fingerprints are collapsed first and all members
of a bucket are verified, in blocks of about ``BLOCK`` members compared with one
another; a pair is verified in the first bucket it shares. ``near_classes`` gives
every document its class and its number of links without listing pairs;
``near_documents`` lists them.

The query needs each document's neighbour in descending doc_id. Ids are cut
into ranges at approximate quantiles; the first document of a range is sent
to the range before it as well (as many extra rows as ranges), so neighbours
meet inside one sorted partition and every text is shuffled once.

Defined results: a NULL text is empty; two empty texts have likeness 1, an
empty and another text 0; rows with equal ids are ordered by a hash of their
text, NULL ids come last; a single document is its own neighbour; repeated
rows give repeated results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir

from .common import shuffle_partitions
from .jaccard_join import _components, components

SEED = 20_240_229
PERIOD = 1024
CLASSES = 128
SAMPLES = 256
BANDS, ROWS = 64, 6  # 95% of the pairs of likeness NEAR share a band
BLOCK = 512  # members of a bucket in a block, on average
NEAR = 0.6  # likeness from which a banded pair counts as verified

_HOME = itemgetter(CLASSES)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64(SEED)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Walk:
    """The shared walk as an automaton over character classes."""

    def __init__(self):
        move = np.random.default_rng(SEED).integers(0, 2, (PERIOD, CLASSES), np.uint8)
        move[0] = 1  # every class moves at least once a period
        nxt = np.empty((PERIOD, CLASSES), np.int64)
        after = np.full(CLASSES, 1)  # step 0 of the next period moves
        for j in range(PERIOD - 1, -1, -1):
            after = np.where(move[j] == 1, (j + 1) % PERIOD, after)
            nxt[j] = after
        self.states: list[list] = [[] for _ in range(PERIOD)]
        for j, state in enumerate(self.states):
            state.extend(self.states[k] for k in nxt[j].tolist())
            state.append(j)
        self.levels = self._levels(1 << 16)

    @staticmethod
    def _levels(n: int) -> np.ndarray:
        """Level of each step: trailing zeros of a hash of its number."""
        h = _mix(np.arange(n))
        low = h & (~h + np.uint64(1))
        return np.where(h == 0, 63, np.log2(np.maximum(low, 1).astype(np.float64))).astype(np.uint8)

    def levels_to(self, n: int) -> np.ndarray:
        if n > len(self.levels):
            self.levels = self._levels(1 << (n - 1).bit_length())
        return self.levels[:n]

    def steps(self, classes: bytes, start: int = 0) -> np.ndarray:
        """Steps (from 0) at which each character is reached, and the end."""
        homes = np.fromiter(
            map(_HOME, accumulate(classes, getitem, initial=self.states[start % PERIOD])),
            np.int64, len(classes) + 1)
        taken = (homes[1:] - homes[:-1]) % PERIOD
        taken[taken == 0] = PERIOD
        return np.concatenate([[0], np.cumsum(taken)])


@dataclass
class Fingerprint:
    level: int
    length: int  # steps of the walk
    sample: np.ndarray  # one byte per sampled step

    def __str__(self) -> str:
        return f"{self.level:02x}{self.length:010x}{self.sample.tobytes().hex()}"

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        return cls(int(text[:2], 16), int(text[2:12], 16),
                   np.frombuffer(bytes.fromhex(text[12:]), np.uint8))


_WALK: list[Walk] = []


def walk() -> Walk:
    if not _WALK:
        _WALK.append(Walk())
    return _WALK[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _classes(codes: np.ndarray) -> bytes:
    folded = np.where(codes < CLASSES, codes, (codes * np.uint32(0x9E3779B1)) >> np.uint32(25))
    return folded.astype(np.uint8).tobytes()


def _sampled(codes: np.ndarray, steps: np.ndarray) -> Fingerprint:
    length = int(steps[-1])
    level = max(0, (max(length, 1) - 1).bit_length() - SAMPLES.bit_length() + 1)
    at = np.nonzero(walk().levels_to(length) >= level)[0]
    seen = codes[np.searchsorted(steps, at, side="right") - 1] if length else codes[:0]
    return Fingerprint(level, length, ((seen * np.uint32(0x85EBCA6B)) >> np.uint32(24))
                       .astype(np.uint8))


@dataclass
class Read:
    """A text with its walk; ``edited`` walks on from the unchanged part."""

    text: str
    codes: np.ndarray
    steps: np.ndarray
    print: Fingerprint
    bands: frozenset[int]  # read once, compared with both neighbours

    @classmethod
    def of(cls, text: str) -> Read:
        codes = _codes(text)
        steps = walk().steps(_classes(codes))
        own = _sampled(codes, steps)
        return cls(text, codes, steps, own, frozenset(bands(own)))

    def edited(self, other: str) -> tuple[Fingerprint, str]:
        """Fingerprint and text after the last third of the characters is
        replaced by as many from the beginning of ``other``."""
        n = len(self.text) // 3
        cut, new = len(self.text) - n, other[:n]
        tail = _codes(new)
        more = walk().steps(_classes(tail), int(self.steps[cut])) + self.steps[cut]
        return _sampled(np.concatenate([self.codes[:cut], tail]),
                        np.concatenate([self.steps[:cut], more])), self.text[:cut] + new


def fingerprint(text: str) -> Fingerprint:
    return Read.of(text).print


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Part of the sampled steps of the longer walk with equal characters."""
    if a.length == b.length == 0:
        return 1.0
    level = max(a.level, b.level)
    levels = walk().levels_to(max(a.length, b.length))

    def coarse(f: Fingerprint) -> np.ndarray:
        if f.level == level:
            return f.sample
        own = levels[:f.length]
        return f.sample[own[own >= f.level] >= level]

    x, y = coarse(a), coarse(b)
    n = min(len(x), len(y))
    return float((x[:n] == y[:n]).sum() / max(len(x), len(y))) if max(len(x), len(y)) else 0.0


_PICKS: list[np.ndarray] = []


def _picks(n: int) -> np.ndarray:
    """(BANDS, ROWS) positions below ``n``: in each place the one of the smallest
    hash, so that walks of ``n`` and fewer steps pick the same with chance of
    the quotient of their lengths."""
    if not _PICKS or n > _PICKS[0].shape[2]:
        size = max(2 * SAMPLES, 1 << (n - 1).bit_length())
        rank = _mix(np.arange(BANDS * ROWS)[:, None] * (1 << 32) + np.arange(size)[None, :])
        new = rank <= np.minimum.accumulate(rank, axis=1)
        least = np.maximum.accumulate(np.where(new, np.arange(size)[None, :], 0), axis=1)
        _PICKS[:] = [least.reshape(BANDS, ROWS, size)]
    return _PICKS[0][:, :, n - 1]


def bands(f: Fingerprint) -> list[int]:
    """Keys of the bands, for the fingerprint's level and the next coarser one.

    A band reads ``ROWS`` of the sampled steps of the whole walk. A row agrees
    with the chance of the likeness, wherever two texts differ.
    """
    keys = []
    own = walk().levels_to(f.length)
    own = own[own >= f.level]
    for level in (f.level, f.level + 1):
        x = f.sample[own >= level]
        key = np.arange(BANDS, dtype=np.uint64) + np.uint64(level << 16)
        if len(x):
            at = _picks(len(x))
            for row in range(ROWS):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15)
                           + (at[:, row].astype(np.uint64) << np.uint64(8)) + x[at[:, row]])
        keys += _mix(key).view(np.int64).tolist()
    return keys


def verified(a: Fingerprint, b: Fingerprint, near: float = NEAR) -> bool:
    """Do the two share a band, and does the whole fingerprint agree?"""
    return not set(bands(a)).isdisjoint(bands(b)) and likeness(a, b) >= near


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [str(fingerprint(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())],
                                             ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fingerprint string")


def _near_pairs(group: pa.Table, near: float) -> pa.Table:
    """Verified pairs of one block pair whose first common band is this one."""
    band, p, q = (group.column(c)[0].as_py() for c in ("band", "p", "q"))
    ids, block = group.column("doc_id").to_numpy(), group.column("block").to_numpy()
    prints = [Fingerprint.parse(t.as_py()) for t in group.column("fingerprint")]
    keys = [set(bands(f)) for f in prints]
    out: list[tuple] = []
    for i, j in combinations(range(len(ids)), 2):
        if ids[i] == ids[j] or (p != q and block[i] == block[j]) or min(keys[i] & keys[j]) != band:
            continue
        like = likeness(prints[i], prints[j])
        if like >= near:
            out.append((max(ids[i], ids[j]), min(ids[i], ids[j]), like))
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(
        (pa.int64(), pa.int64(), pa.float64()))], ["doc_id", "near_id", "likeness"])


def banded(prints: DataFrame) -> DataFrame:
    """(band, *columns) for every band of every row of ``prints`` (fingerprint, ...)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("fingerprint")
            keys = [sorted(set(bands(Fingerprint.parse(t)))) for t in batch.column(at).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            flat = pa.array([b for k in keys for b in k], pa.int64())
            yield pa.RecordBatch.from_arrays([flat, *[c.take(row) for c in batch.columns]],
                                             ["band", *batch.schema.names])

    kinds = ", ".join(f"{c} {k}" for c, k in prints.dtypes)
    return prints.mapInArrow(run, f"band long, {kinds}")


def _units(members: DataFrame) -> DataFrame:
    """Every member of a bucket of two or more, once for each block pair (p, q) that
    its block is part of: what one group holds is bounded."""
    sizes = members.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"),
                                        F.count(F.lit(1)).alias("n")).filter("n > 1")
    return members.join(sizes.drop("n"), "band").withColumn(
        "block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn(
        "p", F.least("block", "other")).withColumn("q", F.greatest("block", "other")).drop(
        "other", "blocks")


def near_documents(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """(doc_id, near_id, likeness): all verified links of documents with different
    fingerprints that share a band, to the smaller id; documents with equal
    fingerprints take part once, as their smallest id.

    Links are pairs: a group of m similar documents has up to m * m / 2."""
    one = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")).filter(
        "doc_id IS NOT NULL").select("doc_id", "fingerprint")
    return _units(banded(one)).groupBy("band", "p", "q").applyInArrow(
        lambda t: _near_pairs(t, near), "doc_id long, near_id long, likeness double")


def likenesses(prints: list[Fingerprint]) -> np.ndarray:
    """Likeness of all pairs of a block, by the coarser level of the two."""
    levels = walk().levels_to(max(f.length for f in prints))
    own, out = np.array([f.level for f in prints]), np.zeros((len(prints), len(prints)))
    for level in set(own.tolist()):
        some = np.nonzero(own <= level)[0]
        rows = [prints[k].sample[(x := levels[:prints[k].length])[x >= prints[k].level] >= level]
                for k in some]
        sizes = np.array([len(r) for r in rows])
        a = np.full((len(rows), max(1, sizes.max())), -1, np.int16)
        for k, r in enumerate(rows):
            a[k, :len(r)] = r
        b = np.where(a < 0, -2, a)  # places beyond the end equal nothing
        for k in range(len(rows)):
            here = (own[some] == level) | (own[some[k]] == level)
            same = (a[k] == b[here]).sum(axis=1)
            out[some[k], some[here]] = same / np.maximum(1, np.maximum(sizes[k], sizes[here]))
    empty = np.array([f.length == 0 for f in prints])
    out[np.ix_(empty, empty)] = 1.0
    return out


def _near_links(group: pa.Table, near: float) -> pa.Table:
    """Links per node and one edge each, over the pairs that share no smaller band."""
    band, p, q = (group.column(c)[0].as_py() for c in ("band", "p", "q"))
    prints = [Fingerprint.parse(t.as_py()) for t in group.column("fingerprint")]
    linked, block = likenesses(prints) >= near, group.column("block").to_numpy()
    if p != q:
        linked &= block[:, None] != block[None, :]
    np.fill_diagonal(linked, False)
    keys = [frozenset(bands(f)) for f in prints]
    for i, j in zip(*np.nonzero(np.triu(linked))):
        if min(keys[i] & keys[j]) != band:
            linked[i, j] = linked[j, i] = False
    root = _components(len(prints), *np.nonzero(linked))
    links = (linked @ group.column("copies").to_numpy().astype(np.float64)).astype(np.int64)
    some, nodes = np.nonzero(links > 0)[0], group.column("node")
    return pa.table({"node": nodes.take(pa.array(some)), "links": pa.array(links[some]),
                     "root": nodes.take(pa.array(root[some]))})


def near_classes(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """doc_id, class_id, n_links and n_copies of every row of ``prints`` (doc_id,
    fingerprint): classes are connected by verified links between fingerprints that
    share a band; ``class_id`` is the class's smallest doc_id (NULL if it has none),
    ``n_links`` the number of other documents linked, equal fingerprints included."""
    checkpoint_dir(prints.sparkSession)
    named = prints.select("doc_id", "fingerprint", F.unhex(F.md5("fingerprint")).alias("node"))
    one = named.groupBy("node").agg(F.first("fingerprint").alias("fingerprint"),
                                    F.min("doc_id").alias("least"),
                                    F.count(F.lit(1)).alias("copies")).checkpoint()
    members = banded(one.select("node", "fingerprint", "copies"))
    found = _units(members).groupBy("band", "p", "q").applyInArrow(
        lambda t: _near_links(t, near), "node binary, links long, root binary").checkpoint()
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = one.drop("fingerprint").join(roots, "node", "left").join(links, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    first = classes.groupBy("root").agg(F.min("least").alias("class_id"))
    classes = classes.join(first, "root").select(
        "node", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return named.select("doc_id", "node").join(classes, "node").select(
        "doc_id", "class_id", (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.col("copies").alias("n_copies"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, "
          "verified_edited boolean, verified_next boolean")


def with_neighbours(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (_range, _extra, doc_id, _h, text), sorted in descending doc_id
    inside partitions; ``_extra`` marks the first row of the next range."""
    n = ranges or shuffle_partitions(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = sorted(set(ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n))) \
        if n > 1 else []
    # how many bounds are above: range 0 holds the largest ids
    above = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]),
                            lambda b: b > F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))))) \
        if bounds else F.lit(0)
    rows = ids.select(above.alias("_range"), F.lit(False).alias("_extra"), "doc_id",
                      F.xxhash64("text").alias("_h"), "text")
    first = F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id", "_h")
    firsts = rows.groupBy("_range").agg(F.max(first).alias("f")).orderBy("_range").collect()
    if not firsts:
        return rows

    def by_range(values: list) -> Column:
        pairs = [F.lit(x) for r, v in zip(firsts, values) for x in (r["_range"], v)]
        return F.element_at(F.create_map(*pairs), F.col("_range"))

    # the first row of a range goes to the range before it, the very first to the last
    before = [firsts[i - 1]["_range"] for i in range(len(firsts))]
    is_first = F.col("_h") == by_range([r["f"]["_h"] for r in firsts])
    same_id = F.col("doc_id").eqNullSafe(by_range([r["f"]["doc_id"] for r in firsts]))
    extra = rows.filter(same_id & is_first).dropDuplicates(["_range"]).select(
        by_range(before).alias("_range"), F.lit(True).alias("_extra"), "doc_id", "_h", "text")
    return rows.unionByName(extra).repartitionById(n, "_range").sortWithinPartitions(
        "_range", "_extra", F.col("doc_id").desc_nulls_last(), F.col("_h").desc())


def compare_neighbours(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """The query's columns: see the module docstring."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64(), pa.bool_(), pa.bool_())

    def compared(doc_id: int | None, own: Read, after: Read) -> tuple:
        edited, text = own.edited(after.text)
        near = likeness(own.print, edited), likeness(own.print, after.print)
        return (doc_id, len(own.text),
                hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                str(own.print), str(edited), *near,
                near[0] >= NEAR and not own.bands.isdisjoint(bands(edited)),
                near[1] >= NEAR and not own.bands.isdisjoint(after.bands))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, doc_id, read text): waits for the row after it
        for batch in batches:
            out: list[tuple] = []
            places, extras, ids = (batch.column(k).to_pylist() for k in (0, 1, 2))
            texts = batch.column(4)
            for k in range(batch.num_rows):
                here = Read.of(texts[k].as_py() or "")
                if held is not None and held[0] == places[k]:
                    out.append(compared(held[1], held[2], here))
                held = None if extras[k] else (places[k], ids[k], here)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    return with_neighbours(docs, ranges).mapInArrow(run, SCHEMA)
