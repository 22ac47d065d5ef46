"""Counts, histograms and summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import known
from .reshaping import explode_array


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def value_histogram(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per distinct value, most frequent first."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *columns)


def _stats(value: Column) -> Column:
    value = known(value)
    return F.struct(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("stdev"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.count_if(value.isNull()).alias("missing"),
    )


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, population stdev, max, min and missing count.

    All columns are summarised in one pass over the data.
    """
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), _stats(F.col(c).cast("double")).alias("s")) for c in columns]
    )
    return df.agg(entries.alias("all")).select(F.inline("all")).select("column", "s.*")


def score_stats(df: DataFrame, scores: str = "scores") -> DataFrame:
    """Per array position: count, mean, stdev, max, min and missing count.

    NULL and NaN both count as missing.  Each task folds its rows to one
    partial result per position, so the shuffle is a handful of rows.
    """
    return (
        explode_array(df, scores, "idx", "_v")
        .groupBy("idx")
        .agg(_stats(F.col("_v")).alias("s"))
        .select("idx", "s.*")
    )


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """How many distinct values a column has."""
    if approximate:
        return df.agg(F.approx_count_distinct(column).alias("n"))
    return df.select(column).distinct().agg(F.count(column).alias("n"))
