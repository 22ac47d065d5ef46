"""Between numeric arrays and Spark ML vectors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, functions as F


def to_vector(array: Column) -> Column:
    return array_to_vector(array.cast("array<double>"))


def to_array(vector: Column) -> Column:
    return vector_to_array(vector)


def sparse_parts(vector: Column) -> tuple[Column, Column]:
    """(indices, values) of a vector column.

    A sparse vector is not densified; a dense one (Spark ML stores mostly
    non-zero vectors that way) gets the indices 0, 1, 2, ...
    """
    inner = F.unwrap_udt(vector)
    every_index = F.transform(inner["values"], lambda _, i: i)
    return F.coalesce(inner["indices"], every_index), inner["values"]


def attribute_metadata(size: int, arity: Mapping[int, int] | None = None) -> dict:
    """Column metadata that marks some vector positions as categorical.

    ``arity`` maps a position to its number of categories.
    """
    arity = dict(arity or {})
    attributes = {
        "numeric": [{"idx": i} for i in range(size) if i not in arity],
        "nominal": [{"idx": i, "num_vals": n} for i, n in sorted(arity.items())],
    }
    # Spark cannot read an empty list back as a list of attributes.
    return {"ml_attr": {"num_attrs": size, "attrs": {kind: a for kind, a in attributes.items() if a}}}
