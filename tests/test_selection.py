"""Percentiles by selection equal the engine's exact percentile."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.operators import selection as sel

VALUES = st.one_of(st.floats(allow_nan=True, width=64), st.integers(-3, 3).map(float),
                   st.sampled_from([0.0, -0.0, 1e-320, -1e-320, 1e308, -1e308, 2.5, None]))


def want(values, q):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    p = q * (len(v) - 1)
    lo, hi = math.floor(p), math.ceil(p)
    return v[lo] if lo == hi or v[lo] == v[hi] else (1 - (p - lo)) * v[lo] + (p - lo) * v[hi]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(VALUES, max_size=12), st.lists(VALUES, max_size=5),
       st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_any_doubles(spark, a, b, q):
    rows = [("a", x, 1) for x in a] + [("b", x, 1) for x in b]
    got = sel.percentiles(spark.createDataFrame(rows, "_k string, _v double, _n long"), q)
    for key, values in (("a", a), ("b", b)):
        expected = want(values, q)
        assert (key in got) == (expected is not None)
        if expected is not None:
            assert got[key] == expected or math.isnan(expected) or math.isclose(got[key], expected, rel_tol=1e-12)


@pytest.mark.parametrize("make", [
    lambda r: round(r.lognormvariate(2.5, .8), 2), lambda r: 7.25, lambda r: r.random() * 1e-9 + 1,
    lambda r: r.choice([1.0, math.nextafter(1.0, 2)]), lambda r: r.choice([-1e300, 5.0, 1e300])])
def test_distributions_and_weights(spark, make):
    rng = random.Random(4)
    values = [make(rng) for _ in range(5000)]
    rows = spark.createDataFrame([(v, rng.randint(1, 3)) for v in values], "v double, n long").repartition(4)
    for q in (0.5, 0.1):
        counts = rows.select(F.lit(0).alias("_k"), F.col("v").alias("_v"), F.col("n").alias("_n"))
        exact = rows.agg(F.expr(f"percentile(v, {q}, n)")).first()[0]
        assert math.isclose(sel.percentiles(counts, q)[0], exact, rel_tol=1e-12)
    both = sel.percentiles(sel.value_counts(rows, ["v", "n"]))
    assert math.isclose(both["v"], rows.agg(F.expr("percentile(v, 0.5)")).first()[0], rel_tol=1e-12)
    assert both["n"] == rows.agg(F.expr("percentile(n, 0.5)")).first()[0]
