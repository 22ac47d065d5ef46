"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread_small_scan(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Hash a scan over all cores when its files split into fewer tasks.

    A small table in one row group is read by one task, which then does all
    the per-row work.  Once the input has at least one split per core, as any
    large table has, the frame comes back unchanged and nothing is shuffled.
    Splits are of equal bytes, which for narrow rows are very many rows: with ``rows``
    there are also tasks enough that each has about so many, of the files' own count.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        tasks = max(tasks, -(-df.count() // rows))
    if df.rdd.getNumPartitions() >= tasks:
        return df
    return df.repartition(tasks, *keys)
