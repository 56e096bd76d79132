"""Hard negatives: exact scores, and rows against brute force."""

import math
import random

import numpy as np
import pytest
from helpers import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, kind string, positives string"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 90), st.integers(1, 30), st.integers(0, 2 ** 31))
def test_scores_are_exact(dims, bits, seed):
    rng = np.random.default_rng(seed)
    top = 1 << min(bits, 28)
    a, b = (rng.integers(-top, top + 1, (n, dims)) for n in (7, 9))
    a[0], b[0], b[1] = top, top, -top
    primes = hn.primes_for(dims * top * top)
    got = hn.Residues(a, primes) @ hn.Residues(b, primes)
    assert (got == np.array([[sum(int(x) * int(y) for x, y in zip(r, q)) for q in b] for r in a])).all()


def brute(rows):
    good = []
    for vec_id, vector, label, *_ in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for a_id, a_label, a in {(i, lab, tuple(v)) for i, lab, v in good if i % 100 == 0}:
        scored = [(-sum(x * y for x, y in zip(a, v)), i, lab) for i, lab, v in good if i != a_id]
        for p_score, p_id, _ in sorted(s for s in scored if s[2] == a_label)[:5]:
            inside = sorted(s for s in scored if s[2] != a_label
                            and 80 * -p_score <= 100 * -s[0] <= 100 * -p_score)[:5]
            out += [(a_id, p_id, k + 1, i, -p_score, -s) for k, (s, i, _) in enumerate(inside)]
    return sorted(out)


def vectors(n=900, dims=12, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for k in range(n):
        c = rng.choice(centres)
        rows.append((k, [x + rng.gauss(0, .2) for x in c], rng.randrange(4)))
    rows += [(k, rows[5][1], rows[5][2]) for k in range(n, n + 300)]  # one hot vector
    rows += [(7, None, 1), (2000, [1.0, None], 1), (2100, [float("nan")], 2), (None, [1.0], 1),
             (2200, [float("inf")] * dims, 1), (2300, [1.0] * dims, None), (2400, [], 1),
             (2500, [1.0, 2.0], 2), (2600, [0.0] * dims, 3)]
    rows += [rows[10], rows[10], rows[500]]
    return [r + ("x",) * 3 for r in rows]


def test_equals_brute_force(spark):
    rows = vectors()
    got = hn.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("vec_id") % 100 == 0)
    found = sorted(tuple(r) for r in got.collect())
    assert len(found) > 100 and found == brute(rows)


def test_several_blocks_of_anchors(spark, monkeypatch):
    rows = vectors(400)
    monkeypatch.setattr(hn, "ANCHORS", 1)
    monkeypatch.setattr(hn, "MOST_CELLS", 3)
    got = hn.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_empty_and_too_large(spark):
    one = F.col("vec_id") % 100 == 0
    for rows in ([], [(0, None, 1, "", "", "")], [(0, [1.0], 1, "", "", "")], [(1, [1.0], 1, "", "", "")]):
        assert hn.mine(spark.createDataFrame(rows, SCHEMA), one).count() == 0
    with pytest.raises(ValueError, match="do not fit"):
        hn.mine(spark.createDataFrame([(0, [1e30], 1, "", "", "")], SCHEMA), one)


def test_sql_agrees(spark):
    import duckdb

    from tripmart.llm import queries
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    want = con.execute(queries.ORACLES["op12_hard_negatives"]).df()
    got = queries.op12_hard_negatives(spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) and rows_of(got) == rows_of(want)
