"""Encoding, packing, counting and coding of token ids against the library."""

import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import SMALL, awkward_rows, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmart.llm import packing, queries, range_coder, token_count, token_files, vocab
from tripmart.llm.vocab import WordEncoder, public_path

PATH = public_path(queries.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = WordEncoder(PATH, limit=300)
MACHINE = token_count.Transducer(PATH, max_states=3000)

pieces = st.sampled_from(["the", " ", "\n", "'", "'s", "'re", "'r", "ll", "tion", "é", "É", "ß", "Σ",
                          "1", "42", "!!", ".", ",", "x.", "\x1c", "\xa0", "́", "漢", "🙂", "İ",
                          "<|endoftext|>", "<|startoftext|>", "<|", "ﬁ", "Ǆ", "١", "a" * 40])
texts = st.one_of(st.text(max_size=40), st.lists(pieces, max_size=25).map("".join))


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(texts)
def test_encoding_is_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = library(text)
    assert ENCODER.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(texts, st.none()), max_size=6), st.integers(1, 60))
def test_encoding_many_texts_is_the_librarys(many, chunk):
    many = [t and t.encode("utf-8", "ignore").decode() for t in many]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(vocab, "CHUNK_BYTES", chunk)
        got = list(ENCODER.encode_all(many))
    want = [library(t or "") for t in many]
    assert [i for ids, _ in got for i in ids] == [i for w in want for i in w]
    assert [n for _, counts in got for n in counts] == [len(w) for w in want]


def test_pieces_are_looked_up_once_a_chunk():
    enc, asked = WordEncoder(PATH), []
    make = enc._pieces
    enc._pieces = lambda pieces: asked.extend(pieces) or make(pieces)
    (ids, counts), = enc.encode_all(["Red fish, blue fish.", None, "it's FISH 'til 1999\nÉté été"] * 50)
    assert ids.tolist() == library("Red fish, blue fish. it's FISH 'til 1999\nÉté été") * 50
    assert counts.sum() == len(ids) and len(counts) == 150
    assert len(asked) == 12  # of 850 pieces


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(1, 30))
def test_transducer_counts_the_librarys_tokens(text, chunk):
    text = text.encode("utf-8", "ignore").decode()
    assert MACHINE.count(text) == MACHINE.count(text, chunk) == len(library(text))


@pytest.mark.parametrize("bound", [0, 1, 2, 7])
def test_counts_hold_when_states_are_dropped(bound):
    small = token_count.Transducer(PATH, max_states=bound)
    for text in ["the cat sat on the mat, didn't it?", "we'll they're x'rest 'r 'v' it's 42 times!!",
                 "naïvé " * 5 + "a" * 40 + "<|endoftext|> tion's 'll", "''s 're 'd'd x.y 漢字 🙂"]:
        assert small.count(text) == small.count(text, 5) == len(library(text)), text


def test_caches_stay_bounded():
    for k in range(2000):
        ENCODER.encode(f"word{k} naïvé{k}")
    assert len(ENCODER.pieces) <= 300 and len(ENCODER.pieces.old) <= 300
    assert len(MACHINE.states) <= 3100


def test_counts_of_a_table(spark):
    rows = awkward_rows()
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"])
                 for r in token_count.count_tokens(frame(spark, rows), PATH).collect())
    want = [(r[0] or 0, len((r[1] or "").encode()), len(library(r[1] or ""))) for r in rows]
    assert got == sorted((a, b, c, c > 2048) for a, b, c in want)
    assert token_count.count_tokens(frame(spark, []), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_best_two_fit(lengths):
    lengths = np.array(lengths, np.int64)
    bins, offsets, n = packing.best_two_fit(lengths, 64)
    assert set(bins) == set(range(n))
    for b in range(n):
        at = 0
        for o, size in sorted(zip(offsets[bins == b], lengths[bins == b])):
            assert o == at
            at += size
        assert at <= 64


def test_two_replace_the_smallest():
    # greedy: 6 + 3 leaves 1; 6 + 2 + 2 is full
    bins, _, n = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert n == 2 and bins[0] == bins[2] == bins[3] != bins[1]


@pytest.mark.parametrize("group", [40, 50_000])
def test_packed_pieces(spark, group):
    rows = awkward_rows()
    got = packing.pack_documents(frame(spark, rows), PATH, group_pieces=group).toPandas()
    assert (got.groupby("sequence_id").length.sum() <= 2048).all()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.to_numpy() == s.length.cumsum().shift(fill_value=0).to_numpy()).all()
    want = []
    for doc_id, text in ((r[0], r[1] or "") for r in rows):
        ids = [*library(text), 0]
        want += [(doc_id or 0, k // 2048, k, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p)))
                 for k in range(0, len(ids), 2048) for p in [ids[k:k + 2048]]]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got[cols].fillna(0).astype(int).itertuples(index=False, name=None)) == sorted(want)
    least = -(-got.length.sum() // 2048)
    assert got.sequence_id.nunique() <= least + 2 * (len(got) // group + 1)
    assert packing.pack_documents(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("n, block, top", [(0, 8, 9), (1, 8, 9), (2, 8, 9), (4000, 256, 1 << 16),
                                           (999, 128, 1 << 20), (60_000, 512, 1 << 17)])
def test_coder_round_trip(n, block, top):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.1, n) % top).astype("<u4")
    if n > 100:
        ids[50:100] = ids[:50]
    model, coded = range_coder.encode_blocks(ids, block)
    assert (range_coder.decode_blocks(model, coded) == ids).all()


def test_coder_learns_and_checks():
    ids = np.tile(np.arange(100, 140, dtype="<u4"), 100)
    model, coded = range_coder.encode_blocks(ids, 1000)
    assert sum(len(d) for _, _, d in coded) < len(ids) / 8  # under a bit an id
    for k in range(4):  # blocks do not depend on each other
        assert (range_coder.decode_blocks(model, coded[k:k + 1]) == ids[k * 1000:(k + 1) * 1000]).all()
    n, crc, data = coded[2]
    broken = bytes([data[0] ^ 64]) + data[1:]
    with pytest.raises(ValueError, match="checksum"):
        range_coder.decode_blocks(model, [(n, crc, broken)])


def test_carries_and_words():
    """Intervals that end just above a border carry through whole runs of words."""
    rng = np.random.default_rng(5)
    ids = np.where(rng.random(200_000) < 0.001, rng.integers(0, 50_000, 200_000), 49_999).astype("<u4")
    for part in (ids, ids[::-1].copy(), np.sort(ids)):
        model, coded = range_coder.encode_blocks(part, 512)
        assert (range_coder.decode_blocks(model, coded) == part).all()
        # a word an id at most, and one at the end
        assert all(len(d) <= 4 * (n + 1) for n, _, d in coded)


def test_too_many_different_ids_are_refused():
    n = range_coder.MOST_SYMBOLS + 1
    with pytest.raises(ValueError, match="different ids"):
        range_coder.encode_blocks(np.arange(n, dtype="<u4"), 2048)


def test_segments_end_with_the_document_that_fills_them(spark, tmp_path):
    docs = spark.createDataFrame([(k, "one two three " * (k % 3)) for k in range(60)],
                                 "doc_id long, text string").coalesce(1)
    token_files.write_ids(docs, PATH, str(tmp_path / "ids"), segment_ids=10)
    rows = spark.read.parquet(str(tmp_path / "ids")).collect()
    for r in rows:
        sizes = [d["n"] for d in r["docs"]]
        assert sum(sizes) == r["n_ids"] and sum(sizes[:-1]) < 10
    by_place = sorted(rows, key=lambda r: (r["part"], r["segment"]))
    assert [d["doc_id"] for r in by_place for d in r["docs"]] == list(range(60))
    assert all(a["n_ids"] >= 10 for a, b in zip(by_place, by_place[1:]) if a["part"] == b["part"])


def test_coder_beats_order_0():
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    ids = np.array([i for t in docs for i in [*library(t or ""), 2]], "<u4")
    model, coded = range_coder.encode_blocks(ids, token_files.block_size(len(ids)))
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    bits = 8 * (len(model) + sum(len(d) for _, _, d in coded)) / len(ids)
    assert bits < -(share * np.log2(share)).sum()  # the model's own size included


def test_token_files(spark, monkeypatch):
    rows = awkward_rows()
    got = token_files.round_trip(frame(spark, rows), PATH).collect()
    by_id = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["start"], r["n_tokens"],
                    r["ids_crc32"]) for r in got)
    at = 0
    for (_, doc_id), start, n, crc in by_id:
        assert start == at
        at += n
    want = []
    for r in rows:
        ids = [*library(r[1] or ""), 2]
        want.append((r[0] or 0, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    assert token_files.round_trip(frame(spark, []), PATH).count() == 0


def test_many_segments(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    token_files.write_ids(docs, PATH, str(tmp_path / "ids"), segment_ids=3000)
    got = token_files.read_ids(spark, str(tmp_path / "ids")).toPandas().sort_values("doc_id")
    texts = docs.toPandas().sort_values("doc_id").text
    at = 0
    for start, ids, text in zip(got.start, got.ids, texts):
        want = [*library(text), 2]
        assert (start, bytes(ids)) == (at, struct.pack(f"<{len(want)}I", *want))
        at += len(want)
    assert spark.read.parquet(str(tmp_path / "ids")).count() > 20
