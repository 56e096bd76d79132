"""Exact percentiles by selection in a few bounded passes.

Nothing is sorted and no table of distinct values is shuffled. The first pass
counts values in logarithmic bins, ``PER_OCTAVE`` of them for each power of two:
a mergeable sketch of at most some 135,000 counters, a few hundred in practice.
Running counts say in which bin the wanted rank lies; the next pass divides the
stretch between that bin's least and greatest value into ``BINS`` equal bins, and
so on until the rank's bin holds one value. Each pass narrows the stretch by
``BINS``; a double has 52 bits, so four more passes are the most there can be
(prices and distances take two in all). Bins are functions of the value that
never decrease, so ranks are exact.

Only counters move: partial sums of each task, then one window over a pass's
counters per key, of which the rows of the wanted ranks reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_OCTAVE = 32
BINS = 1 << 16
_INFINITE = 1_000_000  # beyond the bin of the largest double


def _log_bin(v: Column) -> Column:
    """Bin of a value's sign and size: 0 for zero, larger for larger values."""
    size = F.abs(v)
    octave = F.when(size == float("inf"), F.lit(_INFINITE)).otherwise(
        F.floor(F.log2(F.when(size < float("inf"), size)) * PER_OCTAVE) + 40_000)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("long") * octave).cast("long")


def _equal_bin(v: Column, low: Column, high: Column) -> Column:
    return F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1)).cast("long")


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(_k, _v, _n) rows, one per row and column, that ``percentiles`` can read."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_k"), F.col(c).cast("double").alias("_v"))
                                for c in cols]))
    return df.select(pairs.alias("p")).select("p._k", "p._v", F.lit(1).cast("long").alias("_n"))


def percentiles(counts: DataFrame, q: float = 0.5) -> dict:
    """Key -> exact percentile ``q`` of its values in (_k, _v, _n) rows.

    ``_n`` counts the rows that a value stands for; a value may be in any number
    of rows. NULL and NaN are no values; a key without values has no entry. With N
    values the position q * (N - 1) is interpolated between its two ranks.
    ``counts`` is read once a pass: keep it cheap to read, or checkpoint it.
    """
    rows = counts.filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.col("_n") > 0)).select(
        "_k", (F.col("_v") + 0.0).alias("_v"), "_n")
    found: dict = {}
    state: dict = {}  # key -> what the last pass said of the bin of its rank
    binned = rows.withColumn("_bin", _log_bin(F.col("_v")))
    while True:
        for r in _bins_of_rank(binned, state, q):
            position = q * (r["total"] - 1)
            part = position - int(position)
            in_bin = int(position) + (part > 0) < r["after"]  # the upper rank too
            if in_bin and r["low"] < r["high"]:
                state[r["_k"]] = r
                continue
            state.pop(r["_k"], None)
            upper = r["high"] if in_bin else r["next"]
            found[r["_k"]] = r["high"] if not part or upper == r["high"] else \
                (1 - part) * r["high"] + part * upper
        if not state:
            return found
        low, high = (_by_key({k: r[c] for k, r in state.items()}, "double") for c in ("low", "high"))
        inside = rows.withColumn("_low", low).withColumn("_high", high).filter(
            (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        binned = inside.withColumn("_bin", _equal_bin(F.col("_v"), F.col("_low"), F.col("_high")))


def _by_key(values: dict, kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for key, value in values.items():
        out = F.when(F.col("_k").eqNullSafe(F.lit(key)), F.lit(value).cast(kind)).otherwise(out)
    return out


def _bins_of_rank(binned: DataFrame, state: dict, q: float) -> list:
    """Per key the bin of the lower of its two ranks: least and greatest value, rows
    before it, rows up to its end, rows of the key, and the next greater value."""
    bins = binned.groupBy("_k", "_bin").agg(F.sum("_n").alias("n"), F.min("_v").alias("low"),
                                            F.max("_v").alias("high"))
    by_key = Window.partitionBy("_k")
    in_order = by_key.orderBy("_bin")

    def known(name: str, kind: str) -> Column:
        return _by_key({k: r[name] for k, r in state.items()}, kind)

    upto = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    marked = bins.select(
        "_k", "low", "high", "n", (upto + F.coalesce(known("before", "long"), F.lit(0))).alias("after"),
        F.coalesce(known("total", "long"), F.sum("n").over(by_key)).alias("total"),
        F.coalesce(F.lead("low").over(in_order), known("next", "double")).alias("next"))
    rank = F.floor(F.lit(float(q)) * (F.col("total") - 1).cast("double"))
    before = F.col("after") - F.col("n")
    return marked.filter((before <= rank) & (rank < F.col("after"))).select(
        "*", before.alias("before")).collect()
