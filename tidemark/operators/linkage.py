"""Profiling and scoring record-linkage comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import known, zero_if_missing
from .reshaping import explode_array

# The score positions that separate matches best.
SCORED_POSITIONS = (2, 5, 6, 7, 8)


def field_contrast(pairs: DataFrame, scores: str = "scores", matched: str = "matched") -> DataFrame:
    """Per position: missing values, and mean over matches minus non-matches."""
    hit, value = F.col("_hit"), known(F.col("_v"))
    contrast = F.avg(F.when(hit, value)) - F.avg(F.when(~hit, value))
    return (
        explode_array(pairs, scores, "idx", "_v", F.col(matched).alias("_hit"))
        .filter(hit.isNotNull())
        .groupBy("idx")
        .agg(F.count_if(value.isNull()).alias("missing"), contrast.alias("mean_difference"))
    )


def with_score(
    pairs: DataFrame,
    positions: Sequence[int] = SCORED_POSITIONS,
    scores: str = "scores",
) -> DataFrame:
    """Add ``score``: the sum of chosen positions, missing ones counting 0."""
    total = F.lit(0.0)
    for i in positions:
        total = total + zero_if_missing(F.get(scores, F.lit(i)))
    return pairs.withColumn("score", total)


def cutoff_counts(scored: DataFrame, cutoffs: Sequence[float], matched: str = "matched") -> DataFrame:
    """Per cut-off: matches and non-matches that score at least that much."""
    entries = F.array(
        *[
            F.struct(
                F.lit(float(c)).alias("cutoff"),
                F.count_if((F.col("score") >= c) & F.col(matched)).alias("matches"),
                F.count_if((F.col("score") >= c) & ~F.col(matched)).alias("non_matches"),
            )
            for c in cutoffs
        ]
    )
    return scored.agg(entries.alias("all")).select(F.inline("all"))
