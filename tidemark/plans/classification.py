"""Classification: split, fit, and measure trees and forests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import DataFrame

from ..operators.evaluation import accuracy, class_metrics, confusion_cells, random_guess_accuracy
from ..operators.sampling import key_split
from ..operators.trees import fit_tree, predict
from ..sources.caching import kept


@dataclass(frozen=True)
class TreeReport:
    first: DecisionTreeClassificationModel
    final: DecisionTreeClassificationModel
    confusion: DataFrame
    held_out_accuracy: DataFrame
    class_metrics: DataFrame
    guess_accuracy: DataFrame
    test_accuracy: DataFrame


def tree_report(
    rows: DataFrame,
    key: str,
    first: dict | None = None,
    final: dict | None = None,
) -> TreeReport:
    """Fit on 80 %, measure on 10 %, then fit on 90 % and measure on the rest.

    The rows are kept in memory or on disk while the fits run.
    ``rows`` has (label, features) and a ``key`` that decides the split.
    """
    first = first or {"impurity": "gini", "depth": 4, "bins": 100}
    final = final or {"impurity": "entropy", "depth": 20, "bins": 300}
    train, held_out, test = key_split(rows, key)
    with kept(rows):
        early = fit_tree(train, **first)
        late = fit_tree(train.unionByName(held_out), **final)
    checked = predict(early, held_out)
    return TreeReport(
        first=early,
        final=late,
        confusion=confusion_cells(checked),
        held_out_accuracy=accuracy(checked),
        class_metrics=class_metrics(checked),
        guess_accuracy=random_guess_accuracy(train, held_out),
        test_accuracy=accuracy(predict(late, test)),
    )
