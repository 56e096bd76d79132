"""Language identification and fingerprints."""

import hashlib
import random
import zlib

import numpy as np
from helpers import SMALL, awkward_rows, frame

from tripmart.llm import fingerprints as fp
from tripmart.llm import language, queries


def test_held_out_accuracy(spark):
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    got = got.merge(docs, on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out & got.lang.notna()]
    assert len(held) > 100 and (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_labels_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit(docs)
    from pyspark.sql import functions as F
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y"))
    a = language.identify(docs, model).toPandas().sort_values("doc_id").lang_pred.tolist()
    assert a == language.identify(other, model).toPandas().sort_values("doc_id").lang_pred.tolist()


def test_unknown_texts_and_sample_bound(spark):
    docs = frame(spark)
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == got[3]["lang_pred"] == "und"
    assert got[1]["score"] == 0 and got[11]["lang_pred"] == "en"
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and {1, 2, 3}.isdisjoint(
        r["doc_id"] for r in kept.collect())
    assert language.identify(frame(spark, [])).count() == 0
    sample = language.training_sample(spark.read.parquet(f"{SMALL}/documents.parquet"), 10)
    assert sample.groupBy("lang").count().filter("count > 10").count() == 0


def test_long_texts_are_read_whole():
    text = "ab" * 10 + "xyz " * (language._CHUNK // 3)
    one = language.features(text)
    old, language._CHUNK = language._CHUNK, 1000
    try:
        assert np.allclose(one, language.features(text), atol=1e-6)
    finally:
        language._CHUNK = old


def test_families_first():
    x = np.vstack([np.append(np.eye(6)[i], 1) for i in range(4) for _ in range(5)])
    model = language.train(x, [c for c in ("de", "en", "es", "fr") for _ in range(5)])
    assert model.family_names == ["germanic", "romance"]
    assert model.pairs["romance"] == [("es", "fr")]


def literal_walk(text: str) -> list[str]:
    """Step by step: write the character, move on where the automaton says so."""
    walk = fp.walk()
    classes = fp._classes(fp._codes(text))
    out, j, state = [], 0, walk.states[0]
    for c, k in zip(text, classes):
        new = state[k]
        moved = (new[fp.CLASSES] - state[fp.CLASSES]) % fp.PERIOD or fp.PERIOD
        out += [c] * moved
        j, state = j + moved, new
    return out


def test_walk_and_sampling():
    text = "Ein längerer Text, 漢字 🙂 " * 40
    read, written = fp.Read.of(text), literal_walk(text)
    assert read.print.length == len(written)
    at = np.nonzero(fp.walk().levels_to(len(written)) >= read.print.level)[0]
    want = [(ord(written[p]) * 0x85EBCA6B % 2**32) >> 24 for p in at]
    assert read.print.sample.tolist() == want
    assert str(fp.Fingerprint.parse(str(read.print))) == str(read.print)


def test_edits_stay_near():
    rng = random.Random(5)
    near, far = [], []
    for _ in range(40):
        a = [rng.choice("etaoin shrdlu") for _ in range(3000)]
        b = list(a)
        for _ in range(3):
            b[rng.randrange(len(b))] = "q"
            del b[rng.randrange(len(b))]
        c = [rng.choice("etaoin shrdlu") for _ in range(3000)]
        fa, fb, fc = (fp.fingerprint("".join(x)) for x in (a, b, c))
        near.append(fp.likeness(fa, fb))
        far.append(fp.likeness(fa, fc))
        assert not fp.verified(fa, fc) and fp.verified(fa, fa)
    assert np.median(near) > 0.75 and max(far) < 0.3
    empty = fp.fingerprint("")
    assert fp.likeness(empty, empty) == 1 and fp.likeness(empty, fa) == 0


def test_bands_find_edits_anywhere():
    """Pairs of likeness NEAR or little more, edited in one place, share a band."""
    rng = random.Random(6)
    for place in (0, 0.5, 1):
        found = pairs = 0
        for n in (700, 1400, 2000, 3000):
            for _ in range(40):
                a = [rng.choice("etaoin shrdlu") for _ in range(n)]
                part = int(n * rng.uniform(0.2, 0.4))
                at = int((n - part) * place)
                b = a[:at] + [rng.choice("etaoin shrdlu") for _ in range(part)] + a[at + part:]
                fa, fb = fp.fingerprint("".join(a)), fp.fingerprint("".join(b))
                if fp.NEAR <= fp.likeness(fa, fb) < 0.75:
                    pairs += 1
                    found += fp.verified(fa, fb)
        assert pairs > 40 and found >= 0.9 * pairs, (place, found, pairs)


def test_neighbours(spark):
    rows = awkward_rows()
    rows = [r for r in rows if r[0] is not None and r[0] != 200]
    unique = list({r[0]: r for r in rows}.values())
    got = fp.compare_neighbours(frame(spark, unique), ranges=4).toPandas().set_index("doc_id")
    order = sorted(unique, key=lambda r: -r[0])
    assert len(got) == len(order)
    for r, after in zip(order, order[1:] + order[:1]):
        text, other = r[1] or "", after[1] or ""
        n = len(text) // 3
        edited = text[:len(text) - n] + other[:n]
        row = got.loc[r[0]]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == str(fp.fingerprint(text))
        assert row.edited_fingerprint == str(fp.fingerprint(edited))
        assert row.near_next == fp.likeness(fp.fingerprint(text), fp.fingerprint(other))


def test_neighbours_of_repeated_and_null_ids(spark):
    rows = awkward_rows()
    got = fp.compare_neighbours(frame(spark, rows), ranges=5)
    assert got.count() == len(rows)
    assert fp.compare_neighbours(frame(spark, [])).count() == 0
    single = fp.compare_neighbours(frame(spark, rows[3:4])).collect()
    assert single[0]["near_next"] == 1


def test_near_documents(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("etaoin shrdlu") for _ in range(2000)) for _ in range(6)]
    rows = [(k, t, "en", "a", 1) + ("x",) * 9 for k, t in enumerate(
        base + [base[0][:1700] + base[2][:300], base[1]])]
    prints = fp.fingerprints(frame(spark, rows))
    got = {(r["doc_id"], r["near_id"]) for r in fp.near_documents(prints).collect()}
    assert got == {(6, 0)}  # equal fingerprints (1 and 7) take part once


def test_near_documents_not_only_of_the_smallest_id(spark, monkeypatch):
    rng = random.Random(10)
    texts = [[rng.choice("etaoin shrdlu") for _ in range(1500)]]
    for _ in range(7):  # each document is near its neighbours, not the first one
        b = list(texts[-1])
        at = rng.randrange(1, 13) * 100
        texts.append(b[:at] + [rng.choice("etaoin shrdlu") for _ in range(150)] + b[at + 150:])
    rows = [(k, "".join(t), "en", "a", 1) + ("x",) * 9 for k, t in enumerate(texts)]
    prints = [fp.fingerprint(r[1]) for r in rows]
    want = {(i, j) for i in range(8) for j in range(i) if fp.verified(prints[i], prints[j])}
    assert len(want) > 7 and {j for _, j in want} > {0}
    for block in (512, 2):
        monkeypatch.setattr(fp, "BLOCK", block)
        got = fp.near_documents(fp.fingerprints(frame(spark, rows))).collect()
        assert sorted((r["doc_id"], r["near_id"]) for r in got) == sorted(want)
    # one band for all: its smallest id is near no other document
    monkeypatch.setattr(fp, "bands", lambda f: [7])
    rows[0] = (0, "other " * 200, *rows[0][2:])
    block = spark.createDataFrame([(r[0], str(fp.fingerprint(r[1])), 7, 0, 0, 0) for r in rows],
                                  "doc_id long, fingerprint string, band long, block long, p long, q long")
    got = fp._near_pairs(block.toArrow(), fp.NEAR).to_pylist()
    want = {(i, j) for i in range(1, 8) for j in range(1, i)
            if fp.likeness(prints[i], prints[j]) >= fp.NEAR}
    assert {(r["doc_id"], r["near_id"]) for r in got} == want and len(want) > 5


def test_near_classes_against_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    rows, kinds = [], {}
    for k in range(12):
        words = [word() for _ in range(rng.choice([60, 200, 500]))]
        base = " ".join(words)
        n = len(base)
        edits = {"end": base[:int(n * .85)] + base[:n - int(n * .85)],
                 "start": "o " + base, "copy": base, "middle": base[:n // 2] + base[n // 2 + 3:],
                 "spread": "".join(c if i % (n // 3) else "x" for i, c in enumerate(base))}
        rows += [(10 * k, base)]
        for e, (kind, text) in enumerate(edits.items()):
            rows.append((10 * k + e + 1, text))
            kinds[10 * k + e + 1] = kind
    rows += [(None, rows[0][1]), (None, "alone " * 30), (900, ""), (901, None), (902, "")]
    rows = [r + ("en", "a", 1) + ("x",) * 9 for r in rows]
    prints = [fp.fingerprint(r[1] or "") for r in rows]
    like = fp.likenesses(prints)
    for i in range(0, len(rows), 5):
        for j in range(0, len(rows), 3):
            assert abs(like[i, j] - fp.likeness(prints[i], prints[j])) < 1e-9
    linked = [[i != j and (str(a) == str(b) or fp.verified(a, b)) for j, b in enumerate(prints)]
              for i, a in enumerate(prints)]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if j == i or linked[i][j]) for i in range(len(rows))]
    ids = {}
    for r, c in zip(rows, label):
        ids.setdefault(c, []).append(r[0])
    want = sorted(repr((r[0], min((x for x in ids[c] if x is not None), default=None), sum(links)))
                  for r, c, links in zip(rows, label, linked))
    for block in (512, 4):
        monkeypatch.setattr(fp, "BLOCK", block)
        got = fp.near_classes(fp.fingerprints(frame(spark, rows))).collect()
        assert sorted(repr((r["doc_id"], r["class_id"], r["n_links"])) for r in got) == want
    by_id = {r["doc_id"]: r["class_id"] for r in got}
    hits = {}
    for k, kind in kinds.items():
        hits.setdefault(kind, []).append(by_id[k] == by_id[k - k % 10])
    assert all(sum(h) >= 0.9 * len(h) for h in hits.values()), hits
    assert fp.near_classes(fp.fingerprints(frame(spark, []))).count() == 0


def test_svm_against_plain_descent():
    rng = np.random.default_rng(5)
    x = np.c_[rng.normal(size=(60, 5)), np.ones(60)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x @ [1, -2, 0.5, 0, 1, 0.3] + rng.normal(0, .2, 60) > 0, 1.0, -1.0)
    y[:7] = 0  # take no part
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), np.where(y < 0, 0.5 / (y < 0).sum(), 0))

    def objective(w):
        return language.PENALTY / 2 * w @ w + (weight * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    w = np.zeros(6)
    for _ in range(60_000):
        w = w - 0.05 * (language.PENALTY * w - 2 * x.T @ (weight * y * np.maximum(0, 1 - y * (x @ w))))
    got = language.linear_svm(x, y, steps=3000)
    assert abs(objective(got) - objective(w)) < 1e-6 and objective(got) < objective(np.zeros(6)) / 2


def test_prediction_is_family_then_votes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit(docs, 60)
    texts = [r["text"] for r in docs.collect() if r["text"]][:60] + ["qwxz zxq", "漢字 漢字", "el la der the"]
    for text in texts:
        x = [*language.features(text).tolist(), 1.0]
        margin = lambda v: sum(float(a) * b for a, b in zip(v, x) if b)
        families = sorted(model.families)
        scores = {f: margin(v) for f, v in zip(families, model.family_vectors)}
        family = max(families, key=lambda f: scores[f])
        votes = dict.fromkeys(model.families[family], 0)
        for (a, b), v in zip(model.pairs[family], model.pair_vectors[family]):
            votes[a if margin(v) >= 0 else b] += 1
        assert model.predict(text)[0] == max(sorted(votes), key=lambda c: votes[c])
