"""The distributed exact percentile equals Spark's percentile aggregate."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tripmart.operators.quantiles import exact_percentile


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float)), min_size=0, max_size=60),
       st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]), st.integers(1, 6))
def test_matches_percentile(spark, values, q, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = df.agg(F.percentile("x", q)).collect()[0][0]
    got = exact_percentile(df, "x", q, num_partitions=parts).collect()[0][0]
    if want is None:
        assert got is None
    else:
        assert abs(got - want) < 1e-9
