"""Splitting rows into disjoint parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import key_bucket

_BUCKETS = 1000


def _bounds(weights: Sequence[float]) -> list[int]:
    total = sum(weights)
    running, bounds = 0.0, [0]
    for w in weights:
        running += w
        bounds.append(round(running / total * _BUCKETS))
    return bounds


def with_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.1, 0.1), name: str = "split") -> DataFrame:
    """Add the part number 0, 1, ... of each row, decided by its key alone.

    The same key falls in the same part in every run, on any partitioning.
    """
    bucket = key_bucket(F.col(key), _BUCKETS)
    part = F.lit(len(weights) - 1)
    for i, upper in reversed(list(enumerate(_bounds(weights)[1:-1]))):
        part = F.when(bucket < upper, i).otherwise(part)
    return df.withColumn(name, part)


def key_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.1, 0.1)) -> list[DataFrame]:
    """Disjoint parts of a frame in about the given proportions."""
    marked = with_split(df, key, weights, "_split")
    return [marked.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def random_split(df: DataFrame, seed: int, weights: Sequence[float] = (0.8, 0.1, 0.1)) -> list[DataFrame]:
    """Spark's seeded split; repeatable only while the partitioning is."""
    return df.randomSplit(list(weights), seed)
