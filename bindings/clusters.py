"""Clustering queries on embeddings and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import last_field
from tidemark.operators.clusters import (
    assign_clusters,
    assign_to_centers,
    center_rows,
    class_means,
    cluster_centers,
    cluster_label_counts,
    far_rows,
    fit_from_centers,
    fit_kmeans,
    mean_distance,
    refine_centers,
    sweep_cluster_counts,
    sweep_given_centers,
)
from tidemark.operators.parsing import parse_connections, with_features
from tidemark.operators.profiling import value_histogram
from tidemark.plans.outliers import outlier_report
from tidemark.sources import load_table, spread_small_scan
from tidemark.sources.caching import kept

from .classes import NEAREST
from .common import embeddings, rounded

COUNTS = (5, 10, 15, 20, 25, 30, 35, 40)
#: Events of a task: their records and vectors, kept, are some hundred bytes each.
EVENTS_PER_TASK = 500_000
#: Rounds that SQL can follow.
ROUNDS = 3


def connection_lines(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """Events as records: number, three words, two numbers, label."""
    fields = [
        F.col("value").cast("string"), F.date_format("ts", "yyyy-MM-dd"), F.col("props"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")), F.col("user_id").cast("string"),
        F.get_json_object("props", "$.k"), F.col("event_type"),
    ]
    events = spread_small_scan(load_table(spark, folder, "events"), "event_id", rows=EVENTS_PER_TASK)
    events = events if where is None else events.filter(where)
    return events.select(F.concat_ws(",", *fields).alias("value"))


def last_field_histogram(spark, folder):
    labels = connection_lines(spark, folder).select(last_field(F.col("value")).alias("label"))
    return value_histogram(labels, "label")


def drop_columns_vectors(spark, folder):
    """Totals of each kept position per label."""
    rows = parse_connections(connection_lines(spark, folder))
    sums = [F.sum(F.get("values", F.lit(i))).alias(f"v{i}") for i in range(3)]
    totals = rows.groupBy("label", F.size("values").alias("width")).agg(F.count(F.lit(1)).alias("n"), *sums)
    return rounded(totals, "v0", "v1", "v2", places=2)


def _near_means(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, label, cluster, distance), cluster being the label of a mean."""
    rows = embeddings(spark, folder)
    means = class_means(rows).collect()
    labels = F.array(*[F.lit(m["label"]) for m in means])
    near = assign_to_centers(rows, [m["center"] for m in means])
    return near.select("vec_id", "label", F.element_at(labels, F.col("cluster") + 1).alias("cluster"), "distance")


def nearest_centroid(spark, folder):
    return rounded(_near_means(spark, folder), "distance")


def label_counts(spark, folder):
    return cluster_label_counts(_near_means(spark, folder))


def distance_mean(spark, folder):
    return rounded(mean_distance(_near_means(spark, folder)), "mean_distance")


def distance_anomalies(spark, folder):
    return rounded(far_rows(_near_means(spark, folder), 100), "distance")


def lloyd_step(spark, folder):
    """Three centres after one round that starts from the three lowest ids."""
    rows = embeddings(spark, folder)
    start = [r["values"] for r in rows.orderBy("vec_id").limit(3).collect()]
    moved = refine_centers(rows, start, 1)
    cells = [(c, d, v) for c, center in enumerate(moved) for d, v in enumerate(center)]
    return rounded(spark.createDataFrame(cells, "cluster INT, dim INT, value DOUBLE"), "value")


def kmeans_fit(spark, folder):
    """Cluster by label counts of a fit with the default two clusters."""
    rows = with_features(embeddings(spark, folder))
    return cluster_label_counts(assign_clusters(rows, fit_kmeans(rows)))


def kmeans_means(spark, folder):
    """Whether the centres of a fit that ran until nothing moved are the means of their rows."""
    rows = with_features(embeddings(spark, folder))
    model = fit_kmeans(rows, 10, iterations=300, tolerance=0.0)
    means = class_means(assign_clusters(rows, model).select("cluster", "values"), "cluster")
    both = cluster_centers(rows, model).join(means.withColumnRenamed("center", "mean"), "cluster")
    gap = F.aggregate(F.zip_with("center", "mean", lambda c, m: F.abs(c - m)), F.lit(0.0), lambda most, g: F.greatest(most, g))
    return both.agg(F.count(F.lit(1)).alias("clusters"), (F.max(gap) < 1e-6).alias("means"))


def kmeans_shape(spark, folder):
    """Whether every row is assigned to the centre nearest to it."""
    rows = with_features(embeddings(spark, folder))
    model = fit_kmeans(rows, 10)
    assigned = assign_clusters(rows, model).withColumnsRenamed({"cluster": "own", "distance": "own_distance"})
    checked = assign_to_centers(assigned, model.clusterCenters())
    same = F.abs(F.col("distance") - F.col("own_distance")) < 1e-9
    return checked.agg(F.count(F.lit(1)).alias("n"), F.bool_and(same).alias("nearest"))


def kmeans_totals(spark, folder):
    """Rows per label, added up over ten fitted clusters."""
    rows = with_features(embeddings(spark, folder))
    counts = cluster_label_counts(assign_clusters(rows, fit_kmeans(rows, 10)))
    return counts.groupBy("label").agg(F.sum("n").alias("n"))


def centers(spark, folder):
    rows = with_features(embeddings(spark, folder))
    return cluster_centers(rows, fit_kmeans(rows, 10)).select("cluster", "json")


def k_sweep(spark, folder):
    return sweep_cluster_counts(with_features(embeddings(spark, folder)))


def event_outlier_shape(spark, folder):
    """Whether outliers are fewer than asked for and the sweep of labels is whole."""
    rows = with_features(parse_connections(connection_lines(spark, folder)))
    report = outlier_report(rows, 20, 100)
    few = report.outliers.agg((F.count(F.lit(1)) < 100).alias("few")).scalar()
    return report.label_counts.groupBy("label").agg(F.sum("n").alias("n")).withColumn("few", few)


def event_outliers(spark, folder):
    """Events far from their centre among 150 clusters."""
    rows = with_features(parse_connections(connection_lines(spark, folder)))
    return outlier_report(rows, 150, 100).outliers.select("label", "cluster", "distance")


def k_sweep_given(spark, folder):
    """Mean distances after three rounds from the rows of the lowest ids, per number of clusters."""
    rows = embeddings(spark, folder)
    first = [r["values"] for r in rows.orderBy("vec_id").limit(max(COUNTS)).collect()]
    return rounded(sweep_given_centers(rows, [first[:k] for k in COUNTS], ROUNDS, 0.0), "mean_distance")


def centers_given(spark, folder):
    """The numbers in the JSON of ten centres after three rounds."""
    rows = embeddings(spark, folder)
    first = [r["values"] for r in rows.orderBy("vec_id").limit(10).collect()]
    table = center_rows(rows, fit_from_centers(rows, first, ROUNDS, 0.0))
    read = table.select(F.from_json("json", "cluster INT, center ARRAY<DOUBLE>").alias("c"))
    return rounded(read.select("c.cluster", F.posexplode("c.center").alias("dim", "value")), "value")


def event_outliers_given(spark, folder):
    """Events far from their centre among 150 clusters, after three rounds from the events of the lowest ids."""
    events = load_table(spark, folder, "events")
    ids = [r["event_id"] for r in events.select("event_id").orderBy("event_id").limit(150).collect()]
    start = parse_connections(connection_lines(spark, folder, F.col("event_id") <= ids[-1])).select("values").collect()
    start = sorted(r["values"] for r in start)
    rows = parse_connections(connection_lines(spark, folder)).select("label", "values")
    with kept(rows) as held:
        centers = fit_from_centers(held, start, ROUNDS, 0.0)
        far = far_rows(assign_to_centers(held, centers), 100).select("label", "distance").collect()
    return rounded(spark.createDataFrame(far, "label STRING, distance DOUBLE"), "distance")


QUERIES = {
    "last_field_histogram": last_field_histogram,
    "drop_columns_vectors": drop_columns_vectors,
    "nearest_centroid": nearest_centroid,
    "cluster_label_counts": label_counts,
    "mean_distance": distance_mean,
    "distance_anomalies": distance_anomalies,
    "lloyd_step": lloyd_step,
    "kmeans_fit": kmeans_fit,
    "kmeans_means": kmeans_means,
    "kmeans_shape": kmeans_shape,
    "kmeans_totals": kmeans_totals,
    "cluster_centers": centers,
    "k_sweep": k_sweep,
    "event_outliers": event_outliers,
    "event_outlier_shape": event_outlier_shape,
    "k_sweep_given": k_sweep_given,
    "cluster_centers_given": centers_given,
    "event_outliers_given": event_outliers_given,
}


def _rounds(points: str, start: str, rounds: int) -> str:
    """CTEs e (id, label, x), c0 (k, c, x), then per round n (k, id, near) and the moved centres."""
    parts = [f"e AS ({points})", f"c0 AS ({start})"]
    for i in range(rounds + 1):
        parts.append(
            f"n{i} AS (SELECT m.k, e.id, min({{'q': list_distance(e.x, m.x), 'c': m.c}}) AS near FROM e CROSS JOIN c{i} m GROUP BY m.k, e.id)"
        )
        parts.append(
            f"""s{i} AS (SELECT k, c, list(v ORDER BY d) AS x FROM (
  SELECT k, c, d, avg(v) AS v FROM (
    SELECT n.k, n.near.c AS c, unnest(e.x) AS v, generate_subscripts(e.x, 1) AS d FROM n{i} n JOIN e USING (id)) GROUP BY k, c, d)
  GROUP BY k, c),
c{i + 1} AS (SELECT k, c, coalesce(s.x, m.x) AS x FROM c{i} m LEFT JOIN s{i} s USING (k, c))"""
        )
    return ",\n".join(parts)


_EMBEDDED = "SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"
_LOWEST = "SELECT k, r AS c, x FROM (SELECT x, row_number() OVER (ORDER BY id) - 1 AS r FROM e) CROSS JOIN (VALUES {k}) t(k) WHERE r < k"
_EVENTS = """SELECT event_id AS id, event_type AS label,
  [value, CAST(user_id AS DOUBLE), CAST(json_extract_string(props, '$.k') AS DOUBLE)] AS x FROM events"""

ORACLE = {
    "k_sweep_given": f"WITH {_rounds(_EMBEDDED, _LOWEST.format(k=', '.join(f'({k})' for k in COUNTS)), ROUNDS)} "
    f"SELECT k, round(avg(near.q), 6) AS mean_distance FROM n{ROUNDS} GROUP BY k",
    "cluster_centers_given": f"WITH {_rounds(_EMBEDDED, _LOWEST.format(k='(10)'), ROUNDS)} "
    "SELECT CAST(c AS INTEGER) AS cluster, CAST(d - 1 AS INTEGER) AS dim, round(v, 6) AS value "
    f"FROM (SELECT c, unnest(x) AS v, generate_subscripts(x, 1) AS d FROM c{ROUNDS})",
    "event_outliers_given": f"WITH {_rounds(_EVENTS, _LOWEST.format(k='(150)'), ROUNDS)} "
    f"SELECT label, round(near.q, 6) AS distance FROM n{ROUNDS} JOIN e USING (id) "
    f"WHERE near.q > (SELECT min(q) FROM (SELECT near.q AS q FROM n{ROUNDS} ORDER BY q DESC LIMIT 100))",
    "event_outlier_shape": "SELECT event_type AS label, count(*) AS n, true AS few FROM events GROUP BY event_type",
    "kmeans_totals": "SELECT label, count(*) AS n FROM embeddings GROUP BY label",
    "last_field_histogram": "SELECT event_type AS label, count(*) AS n FROM events GROUP BY event_type",
    "drop_columns_vectors": "SELECT event_type AS label, 3 AS width, count(*) AS n, round(sum(value), 2) AS v0, "
    "round(CAST(sum(user_id) AS DOUBLE), 2) AS v1, "
    "round(sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 2) AS v2 FROM events GROUP BY event_type",
    "nearest_centroid": f"WITH {NEAREST} SELECT vec_id, label, cluster, round(distance, 6) AS distance FROM near",
    "cluster_label_counts": f"WITH {NEAREST} SELECT cluster, label, count(*) AS n FROM near GROUP BY ALL",
    "mean_distance": f"WITH {NEAREST} SELECT round(avg(distance), 6) AS mean_distance FROM near",
    "distance_anomalies": f"WITH {NEAREST} SELECT vec_id, label, cluster, round(distance, 6) AS distance FROM near "
    "WHERE distance > (SELECT min(distance) FROM (SELECT distance FROM near ORDER BY distance DESC LIMIT 100))",
    "lloyd_step": """WITH e AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
start AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS c FROM embeddings ORDER BY vec_id LIMIT 3),
far AS (
  SELECT e.vec_id, start.c, sum((e.v - s.v) * (e.v - s.v)) AS q
  FROM e JOIN e s USING (d) JOIN start ON start.vec_id = s.vec_id GROUP BY e.vec_id, start.c),
near AS (SELECT vec_id, arg_min(c, q) AS c FROM far GROUP BY vec_id)
SELECT CAST(c AS INTEGER) AS cluster, CAST(d - 1 AS INTEGER) AS dim, round(avg(v), 6) AS value
FROM e JOIN near USING (vec_id) GROUP BY c, d""",
    "kmeans_means": "SELECT CAST(10 AS BIGINT) AS clusters, true AS means",
    "kmeans_shape": "SELECT count(*) AS n, true AS nearest FROM embeddings",
}
