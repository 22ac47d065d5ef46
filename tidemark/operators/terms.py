"""Tokens, term and document frequency, TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.stopwords import STOP_WORDS
from ..functions.text import html_to_text, token_list, wiki_to_text, without_stop_words
from ..sources.scratch import checkpointed
from .lookups import lookup_join
from .ranking import dense_ids
from .reshaping import explode_array

# How many of the most frequent terms a salted vocabulary join spreads.
HOT_TERMS = 1000

# Fixed value: namespace number of encyclopedia articles.
ARTICLE_NAMESPACE = 0


def article_pages(pages: DataFrame) -> DataFrame:
    """Keep real articles, as (title, content) in plain text.

    Empty pages, pages outside the article namespace, redirects and
    disambiguation pages are left out.
    """
    text = F.col("revision.text")
    kept = pages.filter(
        text.isNotNull()
        & (F.length(F.trim(text)) > 0)
        & (F.col("ns") == ARTICLE_NAMESPACE)
        & F.col("redirect").isNull()
        & F.col("title").isNotNull()
        & ~F.col("title").contains("(disambiguation)")
    )
    return kept.select("title", wiki_to_text(text).alias("content"))


def page_texts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, title, content) of HTML pages."""
    title = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1)
    return pages.select(key, html_to_text(title).alias("title"), html_to_text(F.col(html)).alias("content"))


def document_tokens(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stop_words: Sequence[str] = STOP_WORDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, tokens, ...keep): the kept words of each document, in order.

    Stop words of a short fixed list are filtered inside the array; for a list
    held in a table see ``exclude_terms``.
    """
    tokens = without_stop_words(token_list(F.col(text)), stop_words) if stop_words else token_list(F.col(text))
    return docs.select(key, tokens.alias("tokens"), *keep)


def explode_tokens(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, term): one row per token."""
    return explode_array(docs, "tokens", "pos", "term", key)


def term_frequency(docs: DataFrame, key: str = "doc_id", min_tokens: int = 2) -> DataFrame:
    """(key, doc_total, term_no, term, tf) for documents with enough tokens.

    Each input row is one document, so equal terms are counted inside the row
    (sort the tokens, then measure the runs) and nothing is shuffled.
    ``term_no`` numbers the terms of a document from 0.
    """
    ordered = docs.select(key, F.size("tokens").alias("doc_total"), F.sort_array("tokens").alias("_sorted"))
    positions = F.transform("_sorted", lambda _, i: i)
    starts = ordered.select(
        key,
        "doc_total",
        "_sorted",
        F.filter(positions, lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1))).alias("_starts"),
    )
    runs = F.transform(
        "_starts",
        lambda start, i: F.struct(
            F.get("_sorted", start).alias("term"),
            (F.coalesce(F.get("_starts", i + 1), F.col("doc_total")) - start).cast("bigint").alias("tf"),
        ),
    )
    kept = F.when(F.col("doc_total") >= min_tokens, runs)
    return starts.select(key, "doc_total", F.posexplode(kept).alias("term_no", "_run")).select(
        key, F.col("doc_total").cast("bigint").alias("doc_total"), "term_no", "_run.term", "_run.tf"
    )


def document_terms(docs: DataFrame, key: str = "doc_id", min_tokens: int = 2) -> DataFrame:
    """(key, term_no, term): the distinct terms of each document, uncounted.

    Enough for document frequencies and a vocabulary, and cheaper than
    ``term_frequency``.
    """
    enough = F.when(F.size("tokens") >= min_tokens, F.col("tokens"))
    distinct = docs.select(key, F.array_distinct(enough).alias("_terms"))
    return explode_array(distinct, "_terms", "term_no", "term", key)


def apply_lemmas(
    tf: DataFrame,
    lemmas: DataFrame,
    key: str = "doc_id",
    max_rows: int | None = None,
) -> DataFrame:
    """Rename terms by a (term, lemma) dictionary and add up their counts."""
    unique = lemmas.groupBy("term").agg(F.min("lemma").alias("lemma"))
    renamed = lookup_join(tf, unique, "term", "left", max_rows, salt_by=[key])
    return renamed.groupBy(key, "doc_total", F.coalesce("lemma", "term").alias("term")).agg(F.sum("tf").alias("tf"))


def document_frequency(terms: DataFrame) -> DataFrame:
    """(term, df): in how many documents each term occurs.

    ``terms`` has one row per document and term.
    """
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def document_count(docs: DataFrame, min_tokens: int = 2) -> DataFrame:
    """How many documents have at least ``min_tokens`` tokens."""
    return docs.agg(F.count_if(F.size("tokens") >= min_tokens).alias("n"))


def inverse_frequency(documents: Column, df: Column) -> Column:
    """ln(N / df), unsmoothed."""
    return F.ln(documents / df)


def vocabulary(terms: DataFrame, num_terms: int | None = None) -> DataFrame:
    """(term_id, term, df, idf) of the most frequent terms, by df then term.

    ``terms`` comes from ``document_terms`` or ``term_frequency``.  The term
    counts are checkpointed: they are far smaller than the text, and
    both the number of documents and the vocabulary come from them, so the
    text is read once.  ``num_terms=None`` keeps every term.
    """
    first_of_document = F.count_if(F.col("term_no") == 0)
    counts = checkpointed(
        terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), first_of_document.alias("_documents"))
    )
    documents = counts.agg(F.sum("_documents")).scalar()
    order = [F.desc("df"), F.col("term")]
    kept = counts.select("term", "df")
    if num_terms is not None:
        kept = kept.orderBy(*order).limit(num_terms)
    numbered = dense_ids(kept, order, "term_id", max_rows=num_terms)
    return numbered.select("term_id", "term", "df", inverse_frequency(documents, F.col("df")).alias("idf"))


def tfidf(tf: DataFrame, vocab: DataFrame, key: str = "doc_id", max_terms: int | None = None) -> DataFrame:
    """(key, term_id, term, weight) with weight = idf * tf / tokens in document.

    ``max_terms`` is the bound the vocabulary was built with, if any.  A
    vocabulary too large to broadcast is joined by a shuffle that spreads its
    most frequent terms.
    """
    joined = lookup_join(
        tf.select(key, "doc_total", "term", "tf"),
        vocab.select("term", "term_id", "idf"),
        "term",
        max_rows=max_terms,
        hot=vocab.orderBy(F.desc("df"), "term").limit(HOT_TERMS).select("term"),
        salt_by=[key],
    )
    weight = F.col("idf") * F.col("tf") / F.col("doc_total")
    return joined.select(key, "term_id", "term", weight.alias("weight"))
