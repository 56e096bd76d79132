"""Operator 7: token ids as compressed binary files, and back.

File format: a Parquet folder whose rows are segments. ``part`` and
``segment`` number them in ascending doc_id order; ``docs`` lists the segment's
documents and their numbers of ids; ``model`` the segment's frequencies, from
which every block starts; ``blocks`` holds the coded ids, in blocks of one size
(the last may be smaller, and segments of fewer than ``BLOCK_IDS * LANES`` ids have
smaller blocks) that are coded and read independently, each with the crc32 of
its ids (see ``range_coder``). Spark's own
writer commits the files, so a lost or repeated task leaves no half segment.

Texts are range-partitioned by doc_id and sorted inside the partitions; a
task encodes its texts and codes a segment whenever ``segment_ids`` ids have
come together. Documents may span blocks but not segments. Reading decodes
segments in parallel; a document's start is the ids before it in its segment
plus those of the segments and parts before, which are summed over one row
per segment and part.

Defined results: a NULL or empty text is the end id alone; NULL ids come
first; rows of equal ids are ordered by a hash of their text, and repeated
rows are written once each; an empty table gives an empty folder and result; a
checksum that does not hold raises; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.session import checkpoint_dir

from .common import scratch_folder, shuffle_partitions
from .range_coder import decode_blocks, encode_blocks
from .vocab import encoder

END_ID = 2
SEGMENT_IDS = 1 << 22
BLOCK_IDS, LANES = 1024, 4096  # a segment below BLOCK_IDS * LANES ids gets smaller blocks
MIN_BLOCK_IDS = 256

SEGMENT_SCHEMA = ("part int, segment int, n_ids long, model binary, "
                  "docs array<struct<doc_id:long,n:long>>, "
                  "blocks array<struct<n:int,crc:long,data:binary>>")
_DOC = pa.struct([("doc_id", pa.int64()), ("n", pa.int64())])
_BLOCK = pa.struct([("n", pa.int32()), ("crc", pa.int64()), ("data", pa.binary())])


def block_size(n_ids: int) -> int:
    return max(MIN_BLOCK_IDS, min(BLOCK_IDS, -(-n_ids // LANES)))


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = END_ID,
              segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of all documents, each followed by ``end_id``."""
    end = np.uint32(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number = encoder(path), TaskContext.get().partitionId(), 0
        held, doc_ids, sizes, n = [], [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held)
            held.clear()
            model, coded = encode_blocks(ids, block_size(n))
            docs_ = pa.StructArray.from_arrays(
                [pa.concat_arrays(doc_ids), pa.array(np.concatenate(sizes))], fields=list(_DOC))
            blocks = [{"n": k, "crc": c, "data": d} for k, c, d in coded]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([n], pa.int64()),
                 pa.array([model], pa.binary()), pa.ListArray.from_arrays([0, len(docs_)], docs_),
                 pa.array([blocks], pa.list_(_BLOCK))],
                ["part", "segment", "n_ids", "model", "docs", "blocks"])

        for batch in batches:
            done = 0  # rows of the batch
            for ids, counts in enc.encode_all(x.as_py() for x in batch.column(1)):
                until = np.cumsum(counts)
                ids, counts = np.insert(ids, until, end), counts + 1
                until += np.arange(1, len(until) + 1)
                row = at = 0
                while row < len(counts):  # a segment ends with the document that fills it
                    stop = min(len(counts), int(np.searchsorted(until, at + segment_ids - n)) + 1)
                    held.append(ids[at:until[stop - 1]])
                    doc_ids.append(batch.column(0).slice(done + row, stop - row))
                    sizes.append(counts[row:stop])
                    n += len(held[-1])
                    row, at = stop, int(until[stop - 1])
                    if n >= segment_ids:
                        yield segment()
                        doc_ids, sizes, n, number = [], [], 0, number + 1
                done += len(counts)
        if sizes:
            yield segment()

    parts = shuffle_partitions(docs.sparkSession)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered.mapInArrow(run, SEGMENT_SCHEMA).write.parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of all documents of a folder; ids as little-endian
    unsigned 32-bit integers in one binary."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    before = (Window.unboundedPreceding, -1)
    per_segment = segments.select("part", "segment", "n_ids")
    per_part = per_segment.groupBy("part").agg(F.sum("n_ids").alias("n"))
    part_start = per_part.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("_part_start"))
    starts = per_segment.withColumn("_in_part", F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("segment").rowsBetween(*before)), F.lit(0))).join(
        part_start, "part").select("part", "segment",
                                   (F.col("_in_part") + F.col("_part_start")).alias("_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                model, docs, blocks, start = (column[k] for column in batch.columns)
                ids = decode_blocks(model.as_py(), [
                    (b["n"], b["crc"], b["data"]) for b in blocks.as_py()])
                sizes = docs.values.field("n").to_numpy()
                ends = np.cumsum(sizes)
                offsets = np.append(0, 4 * ends).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [docs.values.field("doc_id"), pa.array(ends - sizes + start.as_py()),
                     pa.BinaryArray.from_buffers(pa.binary(), len(ends), [
                         None, pa.py_buffer(offsets), pa.py_buffer(ids)])],
                    ["doc_id", "start", "ids"])

    return segments.join(starts, ["part", "segment"]).select(
        "model", "docs", "blocks", "_start").mapInArrow(
        run, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of files written and read back."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    with scratch_folder(spark, "token-files") as folder:
        write_ids(docs, path, folder)
        return read_ids(spark, folder).select(
            "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32")).checkpoint()
