"""Repeatable row sampling and splitting by key hash (F3, X3): of about a given
size by a threshold, of exactly that size by selecting the threshold.

``DataFrame.sample(seed=...)`` depends on how rows are laid out over
partitions; hashing a row key does not, so the same rows are chosen on any
cluster size and on every re-run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_bucket(key: str | Column, seed: int = 42, buckets: int = 100) -> Column:
    """A number in [0, buckets) from md5 of ``seed:key``."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws(":", F.lit(str(seed)), k.cast("string"))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(buckets)


def hash_sample(df: DataFrame, key: str, fraction: float = 0.7, seed: int = 42) -> DataFrame:
    """keep about ``fraction`` of rows, without replacement, repeatably."""
    return df.filter(key_bucket(key, seed, 10000) < F.lit(int(round(fraction * 10000))))


def hash_split(df: DataFrame, key: str, test_fraction: float = 0.2,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) parts by key hash; each row lands in exactly one."""
    is_test = key_bucket(key, seed, 10000) < F.lit(int(round(test_fraction * 10000)))
    return df.filter(~is_test), df.filter(is_test)


def split_label(key: str, test_fraction: float = 0.2, seed: int = 42) -> Column:
    """'test' or 'train' for a row, the same rule as :func:`hash_split`."""
    is_test = key_bucket(key, seed, 10000) < F.lit(int(round(test_fraction * 10000)))
    return F.when(is_test, F.lit("test")).otherwise(F.lit("train"))


_HASH_BITS, _DIGIT = 60, 15  # of a key's hash, and those looked at in one pass
_FEW = 10_000  # rows that are sorted in one window


def key_hash(key: str | Column, seed: int = 42) -> Column:
    """A number of 60 bits from md5 of ``seed:key`` (a NULL key counts as empty)."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("bigint")


def _threshold(df: DataFrame, key: str, k: int, seed: int) -> tuple[int, str] | None:
    """The ``k``-th smallest (hash, key) of the rows.

    Selected digit by digit: a pass counts the next 15 bits of the hashes that
    agree so far (32,768 counters at most) and keeps the digit that holds the
    rank; once few rows agree, or all bits do, the rest are ranked themselves.
    """
    rows = df.select(key_hash(key, seed).alias("h"),
                     F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"))
    left, shift = k, _HASH_BITS
    while shift:
        shift -= _DIGIT
        upto = F.sum("n").over(Window.orderBy("digit"))  # over the counters of one pass
        hit = rows.groupBy(F.shiftright("h", shift).alias("digit")).agg(
            F.count(F.lit(1)).alias("n")).withColumn("upto", upto).filter(
            (F.col("upto") >= left) & (F.col("upto") - F.col("n") < left)).first()
        if hit is None:
            return None
        left -= hit["upto"] - hit["n"]
        rows = rows.filter(F.shiftright("h", shift) == hit["digit"])
        if hit["n"] <= _FEW:
            break
    # equal keys are counted together: a key that repeats is one row here
    keys = rows.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("h", "k"))
    last = keys.withColumn("upto", upto).filter(F.col("upto") >= left).orderBy("upto").first()
    return last["h"], last["k"]


def _first_by_hash(df: DataFrame, key: str, fraction: float, seed: int) -> Column:
    wanted = int(fraction * df.count() + 0.5)
    last = _threshold(df, key, wanted, seed) if wanted else None
    if last is None:
        return F.lit(False)
    h, k = key_hash(key, seed), F.coalesce(F.col(key).cast("string"), F.lit(""))
    return (h < last[0]) | ((h == last[0]) & (k <= last[1]))


def exact_sample(df: DataFrame, key: str, fraction: float = 0.7, seed: int = 42) -> DataFrame:
    """exactly ``fraction`` of the rows (rounded half up), those of the smallest
    key hashes, ties by key; the same rows however they are partitioned.

    Rows of one key stay or go together, so with repeated keys the sample may be
    larger by the rows of one key."""
    return df.filter(_first_by_hash(df, key, fraction, seed))


def exact_split(df: DataFrame, key: str, test_fraction: float = 0.2,
                seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``test_fraction`` of the rows in test."""
    is_test = _first_by_hash(df, key, test_fraction, seed)
    return df.filter(~is_test), df.filter(is_test)
