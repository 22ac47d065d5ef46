"""XML dumps made of repeated record elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAGE_SCHEMA = "title STRING, ns INT, redirect STRUCT<_title: STRING>, revision STRUCT<text: STRING>"


def read_tagged_xml(spark: SparkSession, path: str, row_tag: str = "page", schema: str = PAGE_SCHEMA) -> DataFrame:
    """One row per ``<row_tag>`` element of the files under ``path``.

    Each file must be one well-formed document, its records below one root.
    """
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", False)
        .schema(schema)
        .load(path)
    )


def write_tagged_xml(df: DataFrame, path: str, row_tag: str = "page", root_tag: str = "mediawiki") -> None:
    """Write one ``<row_tag>`` element per row, below one root per file."""
    df.write.mode("errorifexists").format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)
