"""Latent concepts: documents to TF-IDF, SVD, top terms and documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.concepts import Decomposition, document_rows, heaviest_documents, top_documents, top_terms, truncated_svd
from ..operators.terms import document_terms, vocabulary
from ..sources.scratch import checkpointed


@dataclass(frozen=True)
class ConceptModel:
    """A fitted analysis.  Its document rows are checkpointed, so nothing stays cached."""

    vocab: DataFrame
    rows: DataFrame
    svd: Decomposition
    key: str

    def singular_values(self) -> DataFrame:
        return self.svd.singular_values(self.rows.sparkSession)

    def top_terms(self, n: int) -> DataFrame:
        return top_terms(self.svd.term_weights(), self.vocab, n)

    def top_documents(self, titles: DataFrame, n: int, title: str = "title") -> DataFrame:
        return top_documents(heaviest_documents(self.svd.documents, n, self.key), titles, n, self.key, title)


def fit_concepts(
    docs: DataFrame,
    k: int,
    num_terms: int | None = 1500,
    key: str = "doc_id",
    r_cond: float = 1e-9,
    **svd,
) -> ConceptModel:
    """Fit on (key, tokens) rows, one row per document; ``num_terms=None`` takes every term.

    The text is read twice: once to count terms, once to build the sparse rows.
    ``svd`` are settings of ``truncated_svd``.
    """
    vocab = checkpointed(vocabulary(document_terms(docs, key), num_terms), free=True)
    rows = checkpointed(document_rows(docs, vocab, key, max_terms=num_terms), free=True)
    return ConceptModel(vocab, rows, truncated_svd(rows, k, key, r_cond=r_cond, **svd), key)
