"""Line-oriented text in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``; ``path`` may be a glob."""
    return spark.read.text(path)


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    """Write one line per row; an existing target is an error."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("errorifexists").text(path)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-case words, column ``term``.

    A line may hold several words parted by blanks or tabs; each counts.
    """
    words = F.explode(F.split(F.lower(F.trim("value")), r"\s+"))
    return read_lines(spark, path).select(words.alias("term")).filter("term <> ''").distinct()
