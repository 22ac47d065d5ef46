"""K-means clusters, distances to centres, and outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.stat import Summarizer
from pyspark.mllib.clustering import KMeans as Rounds, KMeansModel as Centers
from pyspark.mllib.linalg import DenseVector
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import euclidean, matrix_literal
from ..functions.vectors import to_array, to_vector
from ..sources.caching import kept
from ..sources.threads import own_properties


def fit_kmeans(
    df: DataFrame, k: int = 2, seed: int = 17, iterations: int = 20, tolerance: float = 1e-4
) -> KMeansModel:
    """Fit on the ``features`` column; keep ``df`` persisted, it is read often."""
    return KMeans(k=k, seed=seed, maxIter=iterations, tol=tolerance).fit(df.select("features"))


def fit_from_centers(
    df: DataFrame, centers: Sequence[Sequence[float]], iterations: int = 20, tolerance: float = 1e-4, values: str = "values"
) -> list[list[float]]:
    """The centres of a fit that begins from given ones, at most ``iterations`` rounds later.

    With a ``tolerance`` of 0 it ends early only when no centre moves.  A centre that
    no row is nearest to stays where it is.
    """
    rows = df.select(F.col(values).cast("array<double>")).rdd.map(lambda row: DenseVector(row[0]))
    start = Centers([DenseVector(c) for c in centers])
    model = Rounds.train(rows, len(centers), iterations, epsilon=tolerance, initialModel=start)
    return [[float(v) for v in c] for c in model.clusterCenters]


def cluster_centers(df: DataFrame, model: KMeansModel) -> DataFrame:
    """(cluster, center, json), one row per cluster."""
    return center_rows(df, model.clusterCenters())


def center_rows(df: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """(cluster, center, json) of given centres, in the session of ``df``."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(centers)]
    centers = df.sparkSession.createDataFrame(rows, "cluster INT, center ARRAY<DOUBLE>")
    return centers.withColumn("json", F.to_json(F.struct("cluster", "center")))


def assign_clusters(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Add ``cluster`` and ``distance`` to the own centre, by a fitted model."""
    own = F.element_at(matrix_literal(model.clusterCenters()), F.col("cluster") + 1)
    assigned = model.transform(df).withColumnRenamed("prediction", "cluster")
    return assigned.withColumn("distance", euclidean(to_array(F.col("features")), own))


def assign_to_centers(df: DataFrame, centers: Sequence[Sequence[float]], values: str = "values") -> DataFrame:
    """Add ``cluster`` and ``distance`` for given centres and array rows.

    A tie goes to the lowest centre.  Batches are compared with all centres by
    one matrix product; rows whose two best centres are too close for that
    product to tell apart are compared exactly.
    """
    fixed = np.asarray(centers, dtype="float64")
    lengths = (fixed**2).sum(axis=1)

    def exact(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
        return ((rows - center) ** 2).sum(axis=1)

    @F.pandas_udf("struct<cluster: int, distance: double>")
    def nearest(batch: pd.Series) -> pd.DataFrame:
        rows = np.stack(batch.to_numpy()).astype("float64")
        own = (rows**2).sum(axis=1)
        rough = own[:, None] - 2.0 * (rows @ fixed.T) + lengths[None, :]
        best = rough.argmin(axis=1)
        margin = 1e-9 * (own + lengths.max()) + 1e-300
        close = rough <= (rough[np.arange(len(rows)), best] + margin)[:, None]
        unclear = np.flatnonzero(close.sum(axis=1) > 1)
        if len(unclear):
            squared = np.stack([exact(rows[unclear], c) for c in fixed], axis=1)
            best[unclear] = squared.argmin(axis=1)
        distance = np.sqrt(((rows - fixed[best]) ** 2).sum(axis=1))
        return pd.DataFrame({"cluster": best.astype("int32"), "distance": distance})

    return df.withColumn("_near", nearest(F.col(values).cast("array<double>"))).select("*", "_near.*").drop("_near")


def class_means(df: DataFrame, label: str = "label", values: str = "values") -> DataFrame:
    """(label, center): the mean vector of each class, by label."""
    mean = Summarizer.mean(to_vector(F.col(values)))
    return df.groupBy(label).agg(to_array(mean).alias("center")).orderBy(label)


def refine_centers(
    df: DataFrame, centers: Sequence[Sequence[float]], iterations: int = 1, values: str = "values"
) -> list[list[float]]:
    """Move given centres by rounds of assign-and-average over all rows.

    A centre that no row is nearest to stays where it is.
    """
    current = [list(c) for c in centers]
    for _ in range(iterations):
        means = class_means(assign_to_centers(df.select(values), current, values), "cluster", values)
        for row in means.collect():
            current[row["cluster"]] = list(row["center"])
    return current


def cluster_label_counts(assigned: DataFrame, label: str = "label") -> DataFrame:
    """(cluster, label, n), highest cluster first."""
    counts = assigned.groupBy("cluster", label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("cluster"), label)


def mean_distance(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.avg("distance").alias("mean_distance"))


def sweep_cluster_counts(
    df: DataFrame,
    counts: Sequence[int] = (5, 10, 15, 20, 25, 30, 35, 40),
    seed: int = 17,
    parallelism: int = 4,
) -> DataFrame:
    """(k, mean_distance) of a fit per k.

    The vectors are kept in memory or on disk while the fits run, a few at a
    time; all fits are then scored in one pass.
    """
    with kept(df.select("features")) as vectors:
        with ThreadPool(min(parallelism, len(counts))) as pool:
            fits = own_properties(df.sparkSession, [partial(fit_kmeans, vectors, k, seed) for k in counts])
            models = pool.map(lambda fit: fit(), fits, chunksize=1)
        scored = vectors
        for i, model in enumerate(models):
            scored = assign_clusters(scored, model).withColumnsRenamed({"cluster": f"_c{i}", "distance": f"_d{i}"})
        means = scored.agg(*[F.avg(f"_d{i}") for i in range(len(counts))]).first()
    return df.sparkSession.createDataFrame(list(zip(counts, means)), "k INT, mean_distance DOUBLE")


def sweep_given_centers(
    df: DataFrame, starts: Sequence[Sequence[Sequence[float]]], iterations: int = 20, tolerance: float = 1e-4, values: str = "values"
) -> DataFrame:
    """(k, mean_distance) of a fit from each of the given sets of centres; all are scored in one pass."""
    with kept(df.select(values)) as rows:
        scored = rows
        for i, start in enumerate(starts):
            near = assign_to_centers(scored, fit_from_centers(rows, start, iterations, tolerance, values), values)
            scored = near.drop("cluster").withColumnRenamed("distance", f"_d{i}")
        means = scored.agg(*[F.avg(f"_d{i}") for i in range(len(starts))]).first()
    return df.sparkSession.createDataFrame([(len(c), m) for c, m in zip(starts, means)], "k INT, mean_distance DOUBLE")


def far_rows(assigned: DataFrame, n: int = 100) -> DataFrame:
    """Rows farther from their centre than the n-th largest distance.

    Fewer than ``n`` rows can be strictly beyond it, and they are all among
    the ``n`` farthest, so one pass that keeps those is enough.  With fewer
    than ``n`` rows the smallest distance takes its place.
    """
    farthest = assigned.orderBy(F.desc("distance")).limit(n)
    nth = F.min("distance").over(Window.partitionBy())
    return farthest.withColumn("_nth", nth).filter(F.col("distance") > F.col("_nth")).drop("_nth")
