"""Join helpers: size-checked broadcast and chained left look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest table broadcast without a planner estimate: at a kilobyte a row, 100 MB.
DEFAULT_MAX_BROADCAST_ROWS = 100_000


def fits(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (one count per task is moved)."""
    return df.count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the row count is proven small.

    Otherwise the frame is returned unchanged and the planner (with AQE) picks
    a shuffled join, so a table that outgrows its bound still joins.
    """
    return F.broadcast(df) if fits(df, max_rows) else df


def null_safe_on(keys: Sequence[str], prefix: str = "_key_") -> Column:
    """Join condition key <=> prefix + key: NULL keys match each other (a NULL
    zone is a group)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def left_lookups(fact: DataFrame, specs: Sequence[tuple[DataFrame, str | Sequence[str], str]],
                 broadcast_max_rows: int | None = None) -> DataFrame:
    """A chain of left look-ups; on a name clash the look-up's column gets a suffix.

    ``specs`` holds (table, key or keys, suffix). Columns are renamed up front,
    so the plan has no ambiguous references.
    """
    out = fact
    for table, key, suffix in specs:
        keys = [key] if isinstance(key, str) else list(key)
        renamed = table.select(*keys, *[
            F.col(c).alias(f"{c}{suffix}" if c in out.columns else c)
            for c in table.columns if c not in keys])
        if broadcast_max_rows is not None:
            renamed = checked_broadcast(renamed, broadcast_max_rows)
        out = out.join(renamed, on=keys, how="left")
    return out
