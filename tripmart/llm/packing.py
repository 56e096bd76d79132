"""Operator 9: best-two-fit packing of tokenized documents.

Documents are tokenized and cut into pieces of at most ``max_tokens`` ids
where they were read (only (id, piece, length, checksum) rows move on). The
pieces are dealt at random to groups of about ``group_pieces`` rows, and each
group is packed on its own: a sequence is filled greedily with the longest
pieces that fit; then its smallest piece is given back if two unpacked
pieces together fill the widened gap more tightly. A group leaves at most a
few sequences short of full, so with tens of thousands of pieces a group the
loss against one global packing is below one sequence in thousands, and no
task ever holds more than a group.

Defined results: a NULL or empty text is the end id alone; equal lengths are
interchangeable and dealt in (doc_id, piece) order; repeated rows are packed
once each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir

from .vocab import encoder

MAX_TOKENS = 2048
GROUP_PIECES = 50_000
END_ID = 0

PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECES_SCHEMA + ", sequence_id long, offset long"


def token_pieces(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS,
                 end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            ids_col, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                ids = enc.encode(texts[i].as_py()) + end
                doc, step = ids_col[i].as_py(), 4 * max_tokens
                for k, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at:at + step]
                    for c, v in zip(cols, (doc, k, at // 4, len(cut) // 4, zlib.crc32(cut))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(),
                                                       pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, PIECES_SCHEMA)


def best_two_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pack ``lengths`` (all in 1..room) into bins of size ``room``.

    Returns (bin, offset) per item and the number of bins. Items of one
    length wait in a queue; a bit per length tells which queues have items,
    so "the longest that fits" is one mask and bit_length.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(lengths, kind="stable")[::-1]
    queues: dict[int, list[int]] = {}
    have = 0
    for i in order.tolist():
        queues.setdefault(int(lengths[i]), []).append(i)
    for size in queues:
        have |= 1 << size
    n_bins = 0

    def longest(gap: int) -> int:
        return (have & ((1 << (gap + 1)) - 1)).bit_length() - 1 if gap > 0 else 0

    def take(size: int) -> int:
        nonlocal have
        item = queues[size].pop()
        if not queues[size]:
            have &= ~(1 << size)
        return item

    while have:
        held: list[tuple[int, int]] = []  # (size, item), sizes descending
        gap = room
        while (size := longest(gap)) > 0:
            held.append((size, take(size)))
            gap -= size
        if gap and have:  # the greedy fill left a gap: two for the smallest
            small = held[-1][0]
            wide = gap + small
            best, pair = small, None
            first = longest(wide - 1)
            while 2 * first > best and first > 0:
                second = longest(min(first, wide - first))
                if second == first and len(queues[first]) < 2:
                    second = longest(first - 1)
                if second > 0 and first + second > best:
                    best, pair = first + second, (first, second)
                    if best == wide:
                        break
                first = longest(first - 1)
            if pair:
                back = held.pop()[1]
                held += [(s, take(s)) for s in pair]
                queues.setdefault(small, []).append(back)
                have |= 1 << small
        at = 0
        for size, item in held:
            bins[item], offsets[item] = n_bins, at
            at += size
        n_bins += 1
    return bins, offsets, n_bins


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Give every piece a (sequence_id, offset); see the module docstring.

    ``pieces`` is written once to the shared checkpoint folder: the groups
    are dealt by position in that table, and a task that runs again must
    find the same rows there.
    """
    spark = pieces.sparkSession
    checkpoint_dir(spark)
    held = pieces.checkpoint()
    groups = max(1, -(-held.count() // group_pieces))
    dealt = held.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()),
                                             F.lit(groups)).cast("long"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("piece", "ascending")])
        number = group.column("_group")[0].as_py()
        bins, offsets, _ = best_two_fit(group.column("length").to_numpy(), max_tokens)
        return group.drop_columns(["_group"]).append_column(
            "sequence_id", pa.array(bins + (number << 40))).append_column(
            "offset", pa.array(offsets))

    return dealt.groupBy("_group").applyInArrow(run, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    return pack(token_pieces(docs, path, max_tokens), max_tokens, group_pieces)
