"""Helpers for the query bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import load_table, spread_small_scan


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round the given columns, so engines that add in another order agree."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text", *columns)
    return spread_small_scan(docs, "doc_id")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, label, values) with double precision values."""
    table = load_table(spark, folder, "embeddings")
    return table.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("values"))
