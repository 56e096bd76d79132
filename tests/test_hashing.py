"""Samples and splits of exactly the asked size."""

import hashlib

import pytest

from tripmart.functions import hashing as h


def want(keys, fraction, seed):
    ranked = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k or ''}".encode()).hexdigest()[:15], k or ""))
    return sorted((k or "") for k in ranked[:int(fraction * len(keys) + 0.5)])


@pytest.mark.parametrize("few", [10_000, 3, 1])
def test_exact_size_at_any_partitioning(spark, monkeypatch, few):
    monkeypatch.setattr(h, "_FEW", few)
    keys = [f"k{i}" for i in range(997)] + [None]
    rows = spark.createDataFrame([(k,) for k in keys], "k string")
    for fraction in (0.0, 0.2, 0.7, 1.0):
        for parts in (1, 7):
            got = h.exact_sample(rows.repartition(parts), "k", fraction, 5)
            assert sorted(r.k or "" for r in got.collect()) == want(keys, fraction, 5)
    train, test = h.exact_split(rows, "k", 0.2, 5)
    assert (train.count(), test.count()) == (998 - 200, 200)


def test_repeated_keys_stay_together_and_empty_tables(spark):
    rows = spark.createDataFrame([("hot",)] * 500 + [(f"k{i}",) for i in range(500)], "k string")
    for seed in range(4):
        got = [r.k for r in h.exact_sample(rows, "k", 0.5, seed).collect()]
        assert got.count("hot") in (0, 500) and 500 <= len(got) < 1000
    assert h.exact_sample(rows.limit(0), "k", 0.5).count() == 0
