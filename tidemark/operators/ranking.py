"""Top-n per group, n-th largest value, dense ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import checkpointed


# Rows that one task may number.
WINDOW_ROWS = 100_000


def top_per_group(df: DataFrame, group: str, n: int, order: Sequence[Column | str], rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group, ranked from 1.

    Spark cuts every input partition to ``n`` rows per group before the
    shuffle (a partial window group limit), so a large group is never moved
    whole.  That cut needs ``n`` within
    ``spark.sql.optimizer.windowGroupLimitThreshold``.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def nth_largest(df: DataFrame, column: str, n: int) -> DataFrame:
    """One row: the n-th largest value, or the smallest of fewer than n rows."""
    return df.select(column).orderBy(F.desc(column)).limit(n).agg(F.min(column).alias(column))


def dense_ids(df: DataFrame, order: Sequence[Column | str], name: str = "id", max_rows: int | None = None) -> DataFrame:
    """Number rows 0, 1, 2, ... in a stated order.

    A frame that is found to have at most ``max_rows`` rows, and no more than
    ``WINDOW_ROWS``, is numbered in one window.  Any other is range-sorted; each row's place inside its partition is then moved by
    the row count of the partitions before it, so no task sees all rows.
    """
    bound = min(max_rows or 0, WINDOW_ROWS)
    if bound and df.limit(bound + 1).count() <= bound:
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
    place = F.monotonically_increasing_id()
    placed = checkpointed(df.orderBy(*order).withColumn("_place", place))
    partition = F.shiftright("_place", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One offset row per partition of the sorted frame: always small.
    return (
        placed.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + inside)
        .drop("_place", "_part", "_before")
    )
