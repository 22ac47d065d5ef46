"""The corpus pipeline: every stage is one text operator, and hands Parquet to the next.

Stages, in order: language identification drops texts without a determinable
language; of each class of near copies the document of the least id stays;
documents that the benchmark contaminates go; personal data and secrets are
replaced; sources are mixed to their target weights.  All stages but the last
return the columns of ``documents``.  Stages that hand texts to Python set a limit
to the session's Arrow batches, if it has none.

Defined cases: an empty table stays empty through all stages; null and empty
texts go in the first stage (they have no language); of repeated rows one stays
after the second; null ids sort last when one document of a class is chosen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, language, mixing, near_copies, surrogates
from tidemark.llm.blocks import small_batches
from tidemark.sources.scratch import scratch_path

#: Share of a document's trigrams that its leading language must account for.
LANGUAGE_SCORE = 0.1
#: Columns that stages read or change.
READ = ("doc_id", "text", "lang", "source")
#: Key of the surrogates' hash; set your own where surrogates must not be guessable.
SURROGATE_KEY = "corpus"


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` applied to ``docs`` with all columns that it does not read under reserved names, so that it replaces none."""
    held = [c if c in READ else f"__own{i}" for i, c in enumerate(docs.columns)]
    return stage(docs.toDF(*held)).select(*[F.col(h).alias(c) for h, c in zip(held, docs.columns, strict=True)])


def _with_length(docs: DataFrame, before: DataFrame, changed: str) -> DataFrame:
    """``docs`` with n_chars after the new text, where ``changed`` says so."""
    if "n_chars" not in before.columns:
        return docs
    own = f"__own{before.columns.index('n_chars')}"
    length = F.length("text").cast(dict(before.dtypes)["n_chars"])
    return docs.withColumn(own, F.when(F.expr(changed), length).otherwise(F.col(own)))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the mixture model determines; it learns from all of them that state one."""
    small_batches(spark)

    def stage(held: DataFrame) -> DataFrame:
        found = language.predict(held, language.fit(held))
        return found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LANGUAGE_SCORE))

    return _apart(docs, stage)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each class of near copies."""
    small_batches(spark)
    return near_copies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than the limit, without spans of a whole window or more."""
    small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    def stage(held: DataFrame) -> DataFrame:
        kept = decontaminate.scan(held, items).filter(~decontaminate.contaminated())
        cut = F.exists("hit_spans", lambda s: s["words"] >= decontaminate.WINDOW).alias("__cut")
        text = F.when(F.col("__cut"), decontaminate.without_spans(words=decontaminate.WINDOW)).otherwise(F.col("text"))
        return _with_length(kept.select("*", cut).withColumn("text", text), docs, "__cut")

    return _apart(docs, stage)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in their texts; n_chars follows the new text."""
    return _apart(docs, lambda held: _with_length(surrogates.replace(held, SURROGATE_KEY), docs, "n_mentions > 0"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and pass, with n_tokens, epoch and order_key."""
    return mixing.mix(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("surrogates", replace_personal_data),
    ("mixing", mix_sources),
]

#: Mixtures, sampled signatures and keyed surrogates cannot be stated in SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
