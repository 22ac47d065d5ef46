"""Record-linkage queries.

The comparison records pair each document with the first document of its
block (same language, same first two words), so there are never more pairs
than documents however large a block is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.linkage import cutoff_counts, field_contrast, with_score
from tidemark.operators.lookups import lookup_join
from tidemark.operators.parsing import drop_header_lines, parse_comparisons, pick_positions
from tidemark.operators.profiling import column_stats, first_rows, row_count, score_stats, value_histogram
from tidemark.operators.ranking import nth_largest
from tidemark.sources import checkpointed, load_table, read_header_csv, read_lines, scratch_path, write_lines

from .common import documents, rounded

FIELDS = [
    "same_source", "same_quality", "length_ratio", "same_toxic", "same_first_line",
    "same_third_word", "same_last_word", "words_ratio", "same_words",
]
HEADER = ",".join(["id_1", "id_2", *FIELDS, "is_match"])


def _compared_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Narrow per-document facts; the text itself is reduced to its hash."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    docs = documents(spark, folder, "lang", "source", "n_chars").withColumn("w", words)

    def word(i: int) -> Column:
        return F.coalesce(F.get("w", F.lit(i)), F.lit(""))

    facts = docs.select(
        "doc_id",
        F.concat_ws("|", "lang", word(0), word(1)).alias("block"),
        "source",
        "n_chars",
        F.size("w").alias("n_words"),
        F.sha2(F.split("text", "\n")[0], 256).alias("first_line"),
        F.get("w", F.lit(2)).alias("third"),
        F.try_element_at("w", F.lit(-1)).alias("last"),
        F.sha2("text", 256).alias("content"),
    )
    # The facts are a small part of the text and are needed twice.
    return checkpointed(facts.join(load_table(spark, folder, "labels"), "doc_id", "left"))


def compared_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(id1, id2, nine comparison fields, matched); NULL where unknown."""
    docs = _compared_documents(spark, folder)
    facts = [c for c in docs.columns if c != "block"]
    first = docs.groupBy("block").agg(F.min_by(F.struct(*facts), "doc_id").alias("a"))
    both = lookup_join(docs, first, "block", salt_by=["doc_id"]).filter(F.col("a.doc_id") < F.col("doc_id"))

    def same(name: str) -> Column:
        return (F.col(f"a.{name}") == F.col(name)).cast("double")

    def ratio(name: str) -> Column:
        a, b = F.col(f"a.{name}").cast("double"), F.col(name).cast("double")
        return F.when(F.greatest(a, b) > 0, F.least(a, b) / F.greatest(a, b))

    return both.select(
        F.col("a.doc_id").alias("id1"),
        F.col("doc_id").alias("id2"),
        same("source").alias("same_source"),
        same("quality").alias("same_quality"),
        ratio("n_chars").alias("length_ratio"),
        same("toxic").alias("same_toxic"),
        same("first_line").alias("same_first_line"),
        same("third").alias("same_third_word"),
        same("last").alias("same_last_word"),
        ratio("n_words").alias("words_ratio"),
        same("n_words").alias("same_words"),
        (F.col("a.content") == F.col("content")).alias("matched"),
    )


def comparison_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs as text lines, behind a header line, "?" where unknown."""
    fields = [F.coalesce(F.col(f).cast("string"), F.lit("?")) for f in FIELDS]
    line = F.concat_ws(",", "id1", "id2", *fields, F.upper(F.col("matched").cast("string")))
    header = spark.createDataFrame([(HEADER,)], "value STRING")
    return header.unionByName(compared_pairs(spark, folder).select(line.alias("value")))


def parsed_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return parse_comparisons(comparison_lines(spark, folder), id_type="bigint")


def linkage_parse(spark, folder):
    pairs = parsed_pairs(spark, folder)
    named = pairs.select(
        "id1", "id2", *[c.alias(f) for c, f in zip(pick_positions(F.col("scores"), range(9)), FIELDS)], "matched"
    )
    return rounded(named, *FIELDS)


def header_csv_scan(spark, folder):
    """Several files, each starting with the header, read back as one table."""
    path = scratch_path(spark, "comparisons")
    table = compared_pairs(spark, folder).withColumnsRenamed({"id1": "id_1", "id2": "id_2", "matched": "is_match"})
    table.write.option("header", True).option("nullValue", "?").csv(path)
    schema = "id_1 BIGINT, id_2 BIGINT, " + ", ".join(f"{f} DOUBLE" for f in FIELDS) + ", is_match BOOLEAN"
    return rounded(read_header_csv(spark, f"{path}/*.csv", schema), *FIELDS)


def header_filter(spark, folder):
    """Lines of the staged text files that are not headers, first ten by text."""
    path = scratch_path(spark, "lines")
    write_lines(comparison_lines(spark, folder), path)
    lines = drop_header_lines(read_lines(spark, f"{path}/part-*"))
    ids = F.split("value", ",")
    typed = lines.select(ids[0].cast("bigint").alias("id1"), ids[1].cast("bigint").alias("id2"))
    return first_rows(typed, 10, "id2")


def line_count(spark, folder):
    return row_count(comparison_lines(spark, folder))


def match_histogram(spark, folder):
    return value_histogram(parsed_pairs(spark, folder), "matched")


def na_stats(spark, folder):
    return rounded(score_stats(parsed_pairs(spark, folder)), "mean", "stdev", "max", "min")


def match_stats(spark, folder):
    """Statistics of matches and of non-matches, side by side."""
    pairs = parsed_pairs(spark, folder)
    hit = score_stats(pairs.filter("matched")).withColumn("matched", F.lit(True))
    miss = score_stats(pairs.filter("not matched")).withColumn("matched", F.lit(False))
    return rounded(hit.unionByName(miss), "mean", "stdev", "max", "min")


def contrast(spark, folder):
    return rounded(field_contrast(parsed_pairs(spark, folder)), "mean_difference")


def score_rows(spark, folder):
    scored = with_score(parsed_pairs(spark, folder))
    return rounded(scored.select("id1", "id2", "matched", "score"), "score")


def score_cutoffs(spark, folder):
    return cutoff_counts(with_score(parsed_pairs(spark, folder)), [4.0, 3.0, 2.0])


def event_histogram(spark, folder):
    return value_histogram(load_table(spark, folder, "events"), "event_type")


def event_column_stats(spark, folder):
    stats = column_stats(load_table(spark, folder, "events"), ["value", "user_id"])
    return rounded(stats, "mean", "stdev", "max", "min", places=4)


def order_column_stats(spark, folder):
    stats = column_stats(load_table(spark, folder, "orders"), ["o_totalprice", "o_custkey"])
    return rounded(stats, "mean", "stdev", "max", "min", places=3)


def hundredth_total(spark, folder):
    """The 100th largest order total."""
    return nth_largest(load_table(spark, folder, "orders"), "o_totalprice", 100)


QUERIES = {
    "linkage_parse": linkage_parse,
    "header_csv_scan": header_csv_scan,
    "header_filter": header_filter,
    "line_count": line_count,
    "match_histogram": match_histogram,
    "na_stats": na_stats,
    "match_stats": match_stats,
    "field_contrast": contrast,
    "linkage_score": score_rows,
    "linkage_score_cutoffs": score_cutoffs,
    "value_histogram": event_histogram,
    "column_stats": event_column_stats,
    "order_column_stats": order_column_stats,
    "nth_largest": hundredth_total,
}

_PAIRS = r"""
WITH words AS (
  SELECT doc_id, lang, source, n_chars, text,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents),
facts AS (
  SELECT words.*, quality, toxic, len(w) AS n_words,
         lang || '|' || coalesce(w[1], '') || '|' || coalesce(w[2], '') AS block
  FROM words LEFT JOIN labels USING (doc_id)),
firsts AS (SELECT block, min(doc_id) AS doc_id FROM facts GROUP BY block),
pairs AS (
  SELECT a.doc_id AS id1, b.doc_id AS id2,
    CAST(a.source = b.source AS DOUBLE) AS same_source,
    CAST(a.quality = b.quality AS DOUBLE) AS same_quality,
    CAST(least(a.n_chars, b.n_chars) AS DOUBLE) / nullif(greatest(a.n_chars, b.n_chars), 0) AS length_ratio,
    CAST(a.toxic = b.toxic AS DOUBLE) AS same_toxic,
    CAST(string_split(a.text, chr(10))[1] = string_split(b.text, chr(10))[1] AS DOUBLE) AS same_first_line,
    CAST(a.w[3] = b.w[3] AS DOUBLE) AS same_third_word,
    CAST(a.w[len(a.w)] = b.w[len(b.w)] AS DOUBLE) AS same_last_word,
    CAST(least(a.n_words, b.n_words) AS DOUBLE) / nullif(greatest(a.n_words, b.n_words), 0) AS words_ratio,
    CAST(a.n_words = b.n_words AS DOUBLE) AS same_words,
    a.text = b.text AS matched
  FROM facts b JOIN firsts USING (block) JOIN facts a ON a.doc_id = firsts.doc_id
  WHERE a.doc_id < b.doc_id)
"""
_LONG = _PAIRS + ", long AS (" + " UNION ALL ".join(
    f"SELECT matched, {i} AS idx, {f} AS v FROM pairs" for i, f in enumerate(FIELDS)
) + ")"
_STATS = (
    "count(v) AS count, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS stdev, "
    "round(max(v), 6) AS max, round(min(v), 6) AS min, count(*) - count(v) AS missing"
)
_ROUNDED = ", ".join(f"round({f}, 6) AS {f}" for f in FIELDS)
_SCORE = "coalesce(length_ratio, 0) + coalesce(same_third_word, 0) + coalesce(same_last_word, 0) + " \
         "coalesce(words_ratio, 0) + coalesce(same_words, 0)"


def _column_stats_sql(table: str, columns: list[str], places: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), {places}) AS mean, "
        f"round(stddev_pop(CAST({c} AS DOUBLE)), {places}) AS stdev, "
        f"round(CAST(max({c}) AS DOUBLE), {places}) AS max, "
        f"round(CAST(min({c}) AS DOUBLE), {places}) AS min, count(*) - count({c}) AS missing FROM {table}"
        for c in columns
    )


ORACLE = {
    "nth_largest": "SELECT min(o_totalprice) AS o_totalprice FROM "
    "(SELECT o_totalprice FROM orders ORDER BY o_totalprice DESC LIMIT 100)",
    "linkage_parse": _PAIRS + f"SELECT id1, id2, {_ROUNDED}, matched FROM pairs",
    "header_csv_scan": _PAIRS + f"SELECT id1 AS id_1, id2 AS id_2, {_ROUNDED}, matched AS is_match FROM pairs",
    "header_filter": _PAIRS + "SELECT id1, id2 FROM pairs ORDER BY id2 LIMIT 10",
    "line_count": _PAIRS + "SELECT count(*) + 1 AS n FROM pairs",
    "match_histogram": _PAIRS + "SELECT matched, count(*) AS n FROM pairs GROUP BY matched",
    "na_stats": _LONG + f"SELECT idx, {_STATS} FROM long GROUP BY idx",
    "match_stats": _LONG + f"SELECT matched, idx, {_STATS} FROM long GROUP BY matched, idx",
    "field_contrast": _LONG
    + "SELECT idx, count(*) - count(v) AS missing, round(avg(v) FILTER (matched) - avg(v) FILTER (NOT matched), 6) "
    "AS mean_difference FROM long GROUP BY idx",
    "linkage_score": _PAIRS + f"SELECT id1, id2, matched, round({_SCORE}, 6) AS score FROM pairs",
    "linkage_score_cutoffs": _PAIRS
    + f", scored AS (SELECT matched, {_SCORE} AS score FROM pairs) "
    + " UNION ALL ".join(
        f"SELECT CAST({c} AS DOUBLE) AS cutoff, count(*) FILTER (matched) AS matches, "
        f"count(*) FILTER (NOT matched) AS non_matches FROM scored WHERE score >= {c}"
        for c in (4.0, 3.0, 2.0)
    ),
    "value_histogram": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "column_stats": _column_stats_sql("events", ["value", "user_id"], 4),
    "order_column_stats": _column_stats_sql("orders", ["o_totalprice", "o_custkey"], 3),
}
