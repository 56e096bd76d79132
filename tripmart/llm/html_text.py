"""Operator 13: main text of web pages by a recurrent block labeller.

Pages are read into blocks (``html_blocks``); a bidirectional LSTM
(``block_labeller``) judges every block with the whole page as context, and the
blocks that it takes for content are joined in page order.

Fitting is bounded: ``SAMPLE`` pages of at most ``SAMPLE_CHARS`` characters, the
first different ones in the order of a hash, give the prose of generated training pages and,
where their markup names the article, examples of their own. It runs inside
one task, and the model (some 150 KB, whatever the table) goes with the function
to where the pages are read; prediction moves no row. That bound holds for the
fit alone: every page is read whole.

Defined results: NULL and empty pages, pages without text and pages of which no
block is content have an empty text; white space of any script counts as white
space; character references that HTML does not know stay as they are; repeated
rows get equal results; NULL ids and urls stay; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .block_labeller import Features, Labeller, trained
from .html_blocks import Block, blocks

SAMPLE, SAMPLE_CHARS = 200, 200_000
AT_ONCE = 512  # pages labelled together


def fit(pages: DataFrame, sample: int = SAMPLE, most_chars: int = SAMPLE_CHARS) -> Labeller:
    """The labeller fitted on the bounded sample; deterministic in the table's rows."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pd.concat([pd.DataFrame({"at": [], "html": []}), *parts]).sort_values(["at", "html"])
        yield pd.DataFrame({"model": [pickle.dumps(trained(found["html"].tolist()))]})

    some = pages.filter(F.length("html").between(1, most_chars)).select(
        F.xxhash64("html", F.lit("sample of pages")).alias("at"), "html")
    # the first distinct hashes, then only their pages: no table of texts is sorted
    first = [r["at"] for r in some.select("at").distinct().orderBy("at").limit(sample).collect()]
    if not first:
        return Labeller()
    row = some.filter(F.col("at") <= first[-1]).dropDuplicates(["at"]).repartition(1).mapInPandas(
        run, "model binary").first()
    return pickle.loads(row["model"])


def content(pages: list[str | None], model: Labeller) -> list[list[tuple[Block, float]]]:
    """Every page's blocks with their scores; above 0 is content."""
    read = [blocks(h) for h in pages]
    scores = model.labels([Features(b) for b in read])
    return [list(zip(b, s.tolist())) for b, s in zip(read, scores)]


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks and n_kept of every page."""
    model = model or fit(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(start, AT_ONCE)
                judged = content(part.column(2).to_pylist(), model)
                kept = [[b.text for b, score in page if score > 0] for page in judged]
                texts = [" ".join(k) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array(np.array([len(t) for t in texts], np.int64)),
                     pa.array(np.array([len(page) for page in judged], np.int64)),
                     pa.array(np.array([len(k) for k in kept], np.int64))],
                    ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string")
                        .alias("url"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
