"""The corpus pipeline against a brute-force version of its stages."""

import collections
import re

from helpers import SMALL, awkward_rows, frame
from test_jaccard import brute
from tokenizers import Tokenizer

import corpus_pipeline
from tripmart.llm import mixing, queries
from tripmart.llm.vocab import public_path


def key(line: str) -> str:
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert len(stage) == 5

    known = stage["language_id"](spark, docs, SMALL)
    assert known.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in known.collect()}
    assert len(rows) >= 0.99 * docs.count()  # clean documents stay

    held = collections.Counter(k for t in rows.values() for k in {key(x) for x in t.split("\n")})
    want = {i: "\n".join(x for x in t.split("\n") if not key(x) or held[key(x)] < 10)
            for i, t in rows.items()}
    lines = stage["line_dedup"](spark, known, SMALL)
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want
    lines = lines.checkpoint()

    one = stage["near_duplicates"](spark, lines, SMALL).checkpoint()
    classes = brute([tuple(r) for r in lines.collect()])
    assert sorted(r["doc_id"] for r in one.collect()) == [i for i, c, _ in classes if i == c]

    mixed = stage["mix_sources"](spark, one, SMALL).checkpoint()
    assert mixed.columns == docs.columns
    plan = {r["doc_id"]: r for r in mixing.mix(one).collect()}
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert times == {i: len(r["positions"]) for i, r in plan.items() if r["positions"]}

    packed = stage["pack_sequences"](spark, mixed, SMALL).toPandas()
    library = Tokenizer.from_file(public_path(queries.TOKENIZER))
    texts = {r["doc_id"]: r["text"] for r in one.collect()}
    total = sum(n * (len(library.encode(texts[i], add_special_tokens=False).ids) + 1)
                for i, n in times.items())
    assert packed.length.sum() == total
    assert (packed.groupby("sequence_id").length.sum() <= 2048).all()

    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, SMALL).toPandas()
    assert sorted(map(tuple, run[cols].values)) == sorted(map(tuple, packed[cols].values))


def test_repeated_rows_are_not_multiplied(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d", "en", "s", 7)] * 2 + [(2, "e f g", "en", "s", 5), (3, None, "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long")
    taken = sum(len(r["positions"]) for r in mixing.mix(docs).collect())
    assert mixing.mixed_documents(docs).count() == taken


def test_awkward_rows_run_through(spark, tmp_path):
    rows = awkward_rows()
    rows += [(k, f"Some clean words of document number {k} that nobody else wrote, {k * 7919} times. " * 4,
              "en", None if k % 2 else "hot", 1) + ("x",) * 9 for k in range(300, 340)]
    rows += [(300, "Another text of an id that is used twice, told in quite other words. " * 3, "en", "b", 1)
             + ("x",) * 9]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    known = stage["language_id"](spark, docs, str(tmp_path))
    one = stage["near_duplicates"](spark, stage["line_dedup"](spark, known, str(tmp_path)), str(tmp_path))
    assert one.columns == docs.columns
    kept = collections.Counter(r["doc_id"] for r in one.collect())
    assert kept[300] == 2 and all(kept[k] == 1 for k in range(301, 340))  # texts differ
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} >= {300, 339} and 1 not in {r["doc_id"] for r in got}
    assert {r["doc_id"] for r in got} <= set(kept)


def test_no_rows_run_through(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
