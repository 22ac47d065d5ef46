"""Classification queries on embeddings and parts."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.vectors import to_array, to_vector
from tidemark.operators.clusters import assign_to_centers, class_means
from tidemark.operators.evaluation import (
    accuracy,
    class_metrics,
    class_priors,
    confusion_cells,
    confusion_matrix,
    random_guess_accuracy,
)
from tidemark.operators.parsing import collapse_indicators, parse_labelled_numbers
from tidemark.operators.sampling import key_split, with_split
from tidemark.operators.trees import fit_forest, fit_tree, grid_search, labelled_vectors, predict, predict_one
from tidemark.plans.classification import tree_report
from tidemark.sources import kept, load_table, spread_small_scan

from .common import embeddings, rounded

DIMENSIONS = 64
# The part types, in the order of their indicator columns.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SIZE_STEPS = [10, 20, 30, 40]


def hash_split(spark, folder):
    return with_split(embeddings(spark, folder), "vec_id").select("vec_id", "label", "split")


def union_train_cv(spark, folder):
    train, held_out, _ = key_split(embeddings(spark, folder).select("vec_id", "label"), "vec_id")
    return train.unionByName(held_out)


def priors(spark, folder):
    train, _, _ = key_split(embeddings(spark, folder).select("vec_id", "label"), "vec_id")
    return rounded(class_priors(train), "share")


def guess_accuracy(spark, folder):
    train, held_out, _ = key_split(embeddings(spark, folder).select("vec_id", "label"), "vec_id")
    return rounded(random_guess_accuracy(train, held_out), "accuracy")


def part_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of key, size, price, type bits, size-step bits and brand class.

    The type bits are one-hot; the size-step bits may be all 0 or several 1.
    """
    type_bits = [F.when(F.col("p_type") == t, "1").otherwise("0") for t in PART_TYPES]
    size_bits = [F.when(F.col("p_size") >= s, "1").otherwise("0") for s in SIZE_STEPS]
    brand = F.regexp_replace("p_brand", "^Brand#", "")
    fields = ["p_partkey", "p_size", "p_retailprice"]
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in fields], *type_bits, *size_bits, brand)
    return spread_small_scan(load_table(spark, folder, "part"), "p_partkey").select(line.alias("value"))


def _collapsed_parts(spark: SparkSession, folder: str) -> DataFrame:
    """(label, values) with values key, size, price, type, size step."""
    return collapse_indicators(parse_labelled_numbers(part_lines(spark, folder)), [(3, 6), (9, 4)])


def label_shift(spark, folder):
    parsed = parse_labelled_numbers(part_lines(spark, folder))
    return parsed.select(
        F.get("values", F.lit(0)).cast("bigint").alias("p_partkey"), "label", F.size("values").alias("features"),
        F.get("values", F.lit(2)).alias("price"),
    )


def onehot_collapse(spark, folder):
    names = ["p_partkey", "size", "price", "type_index", "step_index"]
    return _collapsed_parts(spark, folder).select(
        "label", *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def _mean_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(label, prediction): the class whose mean vector is nearest."""
    rows = embeddings(spark, folder)
    means = class_means(rows).collect()
    labels = F.array(*[F.lit(float(m["label"])) for m in means])
    near = assign_to_centers(rows, [m["center"] for m in means])
    return near.select(
        F.col("label").cast("double").alias("label"), F.element_at(labels, F.col("cluster") + 1).alias("prediction")
    )


def confusion(spark, folder):
    return confusion_cells(_mean_predictions(spark, folder))


def confusion_wide(spark, folder):
    wide = confusion_matrix(_mean_predictions(spark, folder), [float(i) for i in range(10)])
    return wide.select("label", *[F.col(f"`{float(i)}`").alias(f"p{i}") for i in range(10)])


def mean_accuracy(spark, folder):
    return rounded(accuracy(_mean_predictions(spark, folder)), "accuracy")


def metrics(spark, folder):
    return rounded(class_metrics(_mean_predictions(spark, folder)), "precision", "recall")


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread_small_scan(embeddings(spark, folder), "vec_id")
    return labelled_vectors(rows, DIMENSIONS, keep=["vec_id"])


def tree_majority(spark, folder):
    """A tree of depth 0 predicts the most frequent class for every row."""
    rows = _vectors(spark, folder)
    return predict(fit_tree(rows, depth=0), rows, "vec_id")


def tree_fit(spark, folder):
    """Per true class: rows and correct rows of the first tree on held-out data."""
    report = tree_report(_vectors(spark, folder), "vec_id")
    cells = report.confusion
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return cells.groupBy("label").agg(F.sum("n").alias("n"), right.alias("right"))


def tree_totals(spark, folder):
    """Held-out rows per true class, added up from the confusion cells of a tree."""
    report = tree_report(_vectors(spark, folder), "vec_id", final={"impurity": "entropy", "depth": 4, "bins": 100})
    return report.confusion.groupBy("label").agg(F.sum("n").alias("n"))


def tree_final(spark, folder):
    """Accuracies of both fits, next to guessing."""
    report = tree_report(_vectors(spark, folder), "vec_id")
    parts = {"guess": report.guess_accuracy, "first": report.held_out_accuracy, "final": report.test_accuracy}
    tables = [t.withColumn("model", F.lit(name)) for name, t in parts.items()]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def tree_beats_guess(spark, folder):
    """Whether a tree is right on its own training rows at least as often as the largest class is common."""
    rows = _vectors(spark, folder)
    with kept(rows):
        model = fit_tree(rows, "entropy", 20, 300)
    scored = predict(model, rows)
    largest = class_priors(rows).agg(F.max("share")).scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("n"), (F.avg((F.col("label") == F.col("prediction")).cast("double")) >= largest).alias("better")
    )


def grid(spark, folder):
    train, held_out, _ = key_split(_vectors(spark, folder), "vec_id")
    return grid_search(train, held_out)


def grid_settings(spark, folder):
    """The settings a search returns, without their accuracies."""
    return grid(spark, folder).select("impurity", "depth", "bins")


def _part_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Brand as the label; type and size step as categorical features."""
    rows = _collapsed_parts(spark, folder)
    keyed = rows.select(
        "label", F.get("values", F.lit(0)).cast("bigint").alias("p_partkey"), F.slice("values", 2, 4).alias("values")
    )
    return labelled_vectors(keyed, 4, arity={2: len(PART_TYPES), 3: len(SIZE_STEPS)}, keep=["p_partkey"])


def grid_categorical(spark, folder):
    train, held_out, _ = key_split(_part_vectors(spark, folder), "p_partkey")
    return grid_search(train, held_out, depths=(10, 20, 30), bins=(40, 300))


def forest_fit(spark, folder):
    """Every row with the forest's prediction."""
    rows = _vectors(spark, folder)
    return predict(fit_forest(rows, bins=300, depth=30), rows, "vec_id")


def forest_shape(spark, folder):
    """One prediction per row, always a known class."""
    rows = _vectors(spark, folder)
    scored = predict(fit_forest(rows, trees=20, depth=10, bins=100), rows, "vec_id")
    labels = rows.select(F.col("label").alias("prediction")).distinct().withColumn("_known", F.lit(True))
    joined = scored.join(labels, "prediction", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("vec_id").alias("ids"),
        F.bool_and(F.coalesce("_known", F.lit(False))).alias("known"),
    )


def forest_full(spark, folder):
    """A forest of full size on categorical features: one known class per row, and better than the largest class.

    The class of one vector must be that of its row in the table.
    """
    rows = _part_vectors(spark, folder).persist()
    model = fit_forest(rows, bins=300, depth=30)
    scored = predict(model, rows, "p_partkey", "features")
    first = scored.orderBy("p_partkey").select("prediction", to_array(F.col("features")).alias("values")).first()
    same = predict_one(model, first["values"]) == first["prediction"]
    largest = class_priors(rows).agg(F.max("share")).scalar()
    labels = rows.select(F.col("label").alias("prediction")).distinct().withColumn("_known", F.lit(True))
    rows.unpersist()
    checked = scored.join(labels, "prediction", "left")
    return checked.agg(
        F.count_distinct("p_partkey").alias("n"), F.bool_and(F.coalesce("_known", F.lit(False))).alias("known"),
        (F.avg((F.col("label") == F.col("prediction")).cast("double")) > largest).alias("better"), F.lit(same).alias("same"),
    )


def single_predict(spark, folder):
    """The class a tree gives the mean vector of the whole table."""
    rows = _vectors(spark, folder)
    model = fit_tree(rows, depth=6)
    center = rows.agg(to_array(Summarizer.mean(F.col("features"))).alias("center")).first()["center"]
    return spark.createDataFrame([(predict_one(model, center),)], "prediction DOUBLE")


QUERIES = {
    "hash_split": hash_split,
    "union_train_cv": union_train_cv,
    "class_priors": priors,
    "random_guess_accuracy": guess_accuracy,
    "label_shift": label_shift,
    "onehot_collapse": onehot_collapse,
    "confusion": confusion,
    "confusion_matrix": confusion_wide,
    "accuracy": mean_accuracy,
    "class_metrics": metrics,
    "tree_majority": tree_majority,
    "tree_fit": tree_fit,
    "tree_totals": tree_totals,
    "tree_final": tree_final,
    "tree_beats_guess": tree_beats_guess,
    "grid_search": grid,
    "grid_settings": grid_settings,
    "grid_categorical": grid_categorical,
    "forest_fit": forest_fit,
    "forest_shape": forest_shape,
    "forest_full": forest_full,
    "single_predict": single_predict,
}

_SPLIT = """split AS (
  SELECT vec_id, label, CASE WHEN bucket < 800 THEN 0 WHEN bucket < 900 THEN 1 ELSE 2 END AS split
  FROM (SELECT vec_id, label,
               CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 AS bucket FROM embeddings))"""
_PRIOR = "SELECT label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM split WHERE split = {s} GROUP BY label"
_TYPE_INDEX = "CASE p_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(PART_TYPES)) + " ELSE 0 END"
_STEP_INDEX = "CASE " + " ".join(
    f"WHEN p_size >= {s} THEN {i}" for i, s in reversed(list(enumerate(SIZE_STEPS)))
) + " ELSE 0 END"
_BRAND = "CAST(CAST(replace(p_brand, 'Brand#', '') AS INTEGER) - 1 AS DOUBLE)"
NEAREST = """e AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
means AS (SELECT label, d, avg(v) AS v FROM e GROUP BY label, d),
distances AS (
  SELECT e.vec_id, e.label, means.label AS cluster, sqrt(sum((e.v - means.v) * (e.v - means.v))) AS distance
  FROM e JOIN means USING (d) GROUP BY e.vec_id, e.label, means.label),
near AS (
  SELECT vec_id, label, arg_min(cluster, distance) AS cluster, min(distance) AS distance
  FROM distances GROUP BY vec_id, label)"""
_PREDICTED = NEAREST + ", p AS (SELECT CAST(label AS DOUBLE) AS label, CAST(cluster AS DOUBLE) AS prediction FROM near)"

ORACLE = {
    "hash_split": f"WITH {_SPLIT} SELECT vec_id, label, split FROM split",
    "union_train_cv": f"WITH {_SPLIT} SELECT vec_id, label FROM split WHERE split < 2",
    "class_priors": f"WITH {_SPLIT} SELECT label, n, round(share, 6) AS share FROM ({_PRIOR.format(s=0)})",
    "random_guess_accuracy": f"WITH {_SPLIT} SELECT round(sum(coalesce(a.share, 0) * coalesce(b.share, 0)), 6) AS accuracy "
    f"FROM ({_PRIOR.format(s=0)}) a FULL JOIN ({_PRIOR.format(s=1)}) b USING (label)",
    "label_shift": f"SELECT p_partkey, {_BRAND} AS label, 13 AS features, p_retailprice AS price FROM part",
    "onehot_collapse": f"SELECT {_BRAND} AS label, CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS size, "
    f"p_retailprice AS price, CAST({_TYPE_INDEX} AS DOUBLE) AS type_index, CAST({_STEP_INDEX} AS DOUBLE) AS step_index FROM part",
    "confusion": f"WITH {_PREDICTED} SELECT label, prediction, count(*) AS n FROM p GROUP BY ALL",
    "confusion_matrix": f"WITH {_PREDICTED} SELECT label, "
    + ", ".join(f"count(*) FILTER (prediction = {i}) AS p{i}" for i in range(10))
    + " FROM p GROUP BY label",
    "accuracy": f"WITH {_PREDICTED} SELECT round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM p",
    "class_metrics": f"WITH {_PREDICTED}, labels_seen AS (SELECT label FROM p UNION SELECT prediction FROM p) "
    "SELECT s.label, round(coalesce(count(*) FILTER (p.label = s.label AND p.prediction = s.label) / "
    "nullif(count(*) FILTER (p.prediction = s.label), 0), 0), 6) AS precision, "
    "round(coalesce(count(*) FILTER (p.label = s.label AND p.prediction = s.label) / "
    "nullif(count(*) FILTER (p.label = s.label), 0), 0), 6) AS recall "
    "FROM labels_seen s CROSS JOIN p GROUP BY s.label",
    "tree_majority": "SELECT CAST(label AS DOUBLE) AS label, vec_id, (SELECT CAST(label AS DOUBLE) FROM embeddings "
    "GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS prediction FROM embeddings",
    "tree_totals": f"WITH {_SPLIT} SELECT CAST(label AS DOUBLE) AS label, count(*) AS n FROM split WHERE split = 1 GROUP BY label",
    "tree_beats_guess": "SELECT count(*) AS n, true AS better FROM embeddings",
    "grid_settings": "SELECT impurity, depth, bins FROM (VALUES ('gini'), ('entropy')) a(impurity) "
    "CROSS JOIN (VALUES (1), (20)) b(depth) CROSS JOIN (VALUES (10), (300)) c(bins)",
    "forest_full": "SELECT count(*) AS n, true AS known, true AS better, true AS same FROM part",
    "forest_shape": "SELECT count(*) AS n, count(DISTINCT vec_id) AS ids, true AS known FROM embeddings",
}
