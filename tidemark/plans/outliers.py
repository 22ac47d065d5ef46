"""Anomaly detection: cluster numeric records and list the far ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame

from ..operators.clusters import assign_clusters, cluster_label_counts, far_rows, fit_kmeans


@dataclass(frozen=True)
class OutlierReport:
    """The tables; ``release`` frees the kept rows."""

    rows: DataFrame
    model: KMeansModel
    label_counts: DataFrame
    outliers: DataFrame

    def release(self) -> None:
        self.rows.unpersist()


def outlier_report(rows: DataFrame, k: int = 150, n: int = 100, seed: int = 17) -> OutlierReport:
    """``rows`` has (label, features, ...); outliers keep all its columns."""
    rows = rows.persist()
    model = fit_kmeans(rows, k, seed)
    assigned = assign_clusters(rows, model)
    return OutlierReport(rows, model, cluster_label_counts(assigned), far_rows(assigned, n))
