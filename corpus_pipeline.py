"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; what it returns is written as Parquet and read again for the next one.
All stages but the last return the columns of ``documents``:

1. language ID: rows without a recognisable language go;
2. line dedup: lines that ten documents or more share go from every text;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. mixing: documents repeated, or left out, as the target weights ask, in the
   order of their training positions;
5. best-fit packing: the pieces of all documents with their place in a
   sequence of 2048 tokens (doc_id, piece, start, length, ids_crc32,
   sequence_id, offset).

Defined results: a NULL or empty text, or one without a letter, has no language and
goes in stage 1; a text that loses all its lines in stage 2 stays, empty, counts
as a class of its own in stage 3 and is not taken by the mix; a NULL doc_id or
source is a value like others; of rows that share an id but differ in text each
is a document; rows repeated as a whole are near duplicates of each other; ties in
size, id and position are broken by hashes of the text; an empty table gives an
empty result; other columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import jaccard_join, language, line_runs, mixing, packing
from tripmart.llm.common import delete_path, workers_import
from tripmart.llm.queries import TOKENIZER
from tripmart.llm.vocab import public_path
from tripmart.session import checkpoint_dir, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return language.keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_runs.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return packing.pack_documents(docs, public_path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# language ID, the join and the tokenizer are not SQL; tests/llm/test_pipeline.py
# holds run() against a brute-force version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, written and read again in between."""
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    checkpoint_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        folder = scratch_path(spark, f"pipeline-{name}")
        if k + 1 < len(STAGES):
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
        else:
            docs = docs.checkpoint()  # rows of numbers: the texts are not needed any more
        if held:
            delete_path(spark, held)
        held = folder
    return docs
