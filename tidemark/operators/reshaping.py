"""Between arrays, maps and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_array(df: DataFrame, array: str, pos: str, value: str, *keep: Column | str) -> DataFrame:
    """One row per array element, with its 0-based position.

    From a plain explode Spark derives a filter on the array and pushes it to
    the scan, where it computes the array a second time.  The outer form gets
    no such filter; its rows for empty arrays are dropped after it.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, value))
    return rows.filter(F.col(pos).isNotNull())


def term_map(tf: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, terms): the term counts of each document as one map, for display."""
    entries = F.array_sort(F.collect_list(F.struct("term", "tf")))
    return tf.groupBy(key).agg(F.map_from_entries(entries).alias("terms"))
