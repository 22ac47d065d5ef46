"""Measures of a classification, from (label, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def class_priors(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, share) of each class, by label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", (F.col("n") / total).alias("share")).orderBy(label)


def random_guess_accuracy(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """How often guessing by the class shares of ``train`` is right on ``test``.

    A class absent on one side counts with share 0.
    """
    a = class_priors(train, label).select(label, F.col("share").alias("_a"))
    b = class_priors(test, label).select(label, F.col("share").alias("_b"))
    both = a.join(b, label, "full_outer")
    agreement = F.sum(F.coalesce("_a", F.lit(0.0)) * F.coalesce("_b", F.lit(0.0)))
    return both.agg(F.coalesce(agreement, F.lit(0.0)).alias("accuracy"))


def confusion_cells(predictions: DataFrame) -> DataFrame:
    """(label, prediction, n), only the pairs that occur."""
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, labels: Sequence[float]) -> DataFrame:
    """One row per true label, one column per predicted label, in label order."""
    ordered = sorted(labels)
    wide = predictions.groupBy("label").pivot("prediction", ordered).agg(F.count(F.lit(1)))
    return wide.na.fill(0).orderBy("label")


def accuracy(predictions: DataFrame) -> DataFrame:
    """The share of rows whose prediction is their label."""
    return predictions.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def class_metrics(predictions: DataFrame) -> DataFrame:
    """(label, precision, recall) per class; 0 where nothing can be divided by.

    Rows are first counted per (label, prediction), so only those cells are
    regrouped.
    """
    cells = confusion_cells(predictions)
    same = F.col("label") == F.col("prediction")
    as_actual = F.struct(
        F.col("label").cast("double").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"),
        F.when(same, F.col("n")).otherwise(0).alias("right"),
    )
    as_predicted = F.struct(
        F.col("prediction").cast("double").alias("label"), F.lit(0).cast("bigint").alias("actual"),
        F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("right"),
    )
    sides = cells.select(F.inline(F.array(as_actual, as_predicted)))
    totals = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "right")])

    def share(of: str):
        return F.when(F.col(of) > 0, F.col("right") / F.col(of)).otherwise(0.0)

    return totals.select("label", share("predicted").alias("precision"), share("actual").alias("recall")).orderBy("label")
