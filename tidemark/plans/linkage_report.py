"""Record linkage: from comparison lines to field contrast and cut-offs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.linkage import cutoff_counts, field_contrast, with_score
from ..operators.parsing import parse_comparisons
from ..operators.profiling import score_stats, value_histogram


@dataclass(frozen=True)
class LinkageReport:
    """The tables; ``release`` frees the kept pairs."""

    pairs: DataFrame
    match_counts: DataFrame
    all_stats: DataFrame
    match_stats: DataFrame
    non_match_stats: DataFrame
    contrast: DataFrame
    cutoffs: DataFrame

    def release(self) -> None:
        self.pairs.unpersist()


def linkage_report(lines: DataFrame, cutoffs: Sequence[float] = (4.0, 2.0), id_type: str = "int") -> LinkageReport:
    """All tables of the analysis; the parsed pairs are kept in memory or on disk for them."""
    pairs = parse_comparisons(lines, id_type=id_type).persist()
    return LinkageReport(
        pairs=pairs,
        match_counts=value_histogram(pairs, "matched"),
        all_stats=score_stats(pairs),
        match_stats=score_stats(pairs.filter("matched")),
        non_match_stats=score_stats(pairs.filter("not matched")),
        contrast=field_contrast(pairs),
        cutoffs=cutoff_counts(with_score(pairs), cutoffs),
    )
