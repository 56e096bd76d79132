"""D3: dense surrogate keys 0..n-1 without a single-task window.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into
one task. Here rows are range-partitioned on (group, order) columns, each
partition numbers its rows locally, and a small table of per-partition
counts turns local numbers into global ones. The only non-parallel step
works on that table, whose size is bounded by partitions + groups.
The numbered rows are checkpointed once (see :func:`assign_key`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shuffles_released
from .joins import checked_broadcast

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number here


def assign_key(df: DataFrame, order_cols: Sequence[str], name: str,
               group_cols: Sequence[str] = (), num_partitions: int | None = None,
               distinct: bool = False) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_cols`` order.

    Numbering restarts at 0 for each combination of ``group_cols`` (which must
    not be NULL); ``order_cols`` must be unique within a group.

    The range-partitioned, locally numbered rows are checkpointed into the
    shared checkpoint folder before the offsets are computed: local numbers
    depend on where the range bounds fall, so both readers (the offset table
    and the final join) must see one materialisation. After that everything
    is a deterministic function of the checkpoint, so a lost executor
    recomputes the same keys. Without ``num_partitions`` AQE picks the number
    of ranges (coalesced ranges stay contiguous).

    ``distinct=True`` numbers distinct rows of ``df``. Duplicates are dropped
    before the range exchange, with partial aggregation first, so a row that
    is repeated any number of times costs one row per map task.
    """
    cols = [*group_cols, *order_cols]
    if distinct:
        df = df.select(*cols).dropDuplicates(cols)
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols))
    numbered = (ranged.sortWithinPartitions(*cols)
                .withColumn("_tm_mid", F.monotonically_increasing_id())
                .withColumn("_tm_part", F.shiftright("_tm_mid", 33))
                .withColumn("_tm_row", F.col("_tm_mid").bitwiseAND(F.lit(_LOW_BITS)))
                .drop("_tm_mid"))
    checkpoint_dir(df.sparkSession)
    with shuffles_released(df.sparkSession):
        numbered = numbered.checkpoint(eager=True)
    # One row per (partition, group): at most partitions + groups - 1 rows,
    # because each partition holds one contiguous range of the sort order.
    counts = numbered.groupBy("_tm_part", *group_cols).agg(
        F.min("_tm_row").alias("_tm_first"), F.count(F.lit(1)).alias("_tm_n"))
    before = Window.partitionBy(*group_cols).orderBy("_tm_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_tm_off", F.coalesce(F.sum("_tm_n").over(before), F.lit(0)))
    keyed = numbered.join(checked_broadcast(offsets.drop("_tm_n")), on=["_tm_part", *group_cols])
    return keyed.withColumn(
        name, (F.col("_tm_off") + F.col("_tm_row") - F.col("_tm_first")).cast("bigint")
    ).drop("_tm_part", "_tm_row", "_tm_first", "_tm_off")


def extend_key(existing: DataFrame, rows: DataFrame, order_cols: Sequence[str], name: str,
               group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """D3 for late rows: the keys of those distinct ``rows`` that have none yet.

    ``existing`` holds the keys given so far (``group_cols``, ``order_cols`` and
    ``name``). They stay as they are; combinations that are new get the next
    numbers of their group, in ``order_cols`` order. Only new combinations are
    returned, so an append is all it takes. Key columns must not be NULL.
    """
    cols = [*group_cols, *order_cols]
    fresh = rows.select(*cols).dropDuplicates(cols).join(existing.select(*cols), cols, "left_anti")
    numbered = assign_key(fresh, order_cols, "_tm_new", group_cols, num_partitions)
    start = existing.groupBy(*group_cols).agg((F.max(name) + 1).alias("_tm_start"))
    if group_cols:
        numbered = numbered.join(checked_broadcast(start), [*group_cols], "left")
    else:
        numbered = numbered.withColumn("_tm_start", start.scalar())
    return numbered.withColumn(name, (F.col("_tm_new") + F.coalesce("_tm_start", F.lit(0)))
                               .cast("bigint")).drop("_tm_new", "_tm_start")
