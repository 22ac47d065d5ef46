"""Latent concepts: document-term matrix, truncated SVD, top terms and documents.

The SVD is that of a randomised range: a few vectors more than concepts are
multiplied by A and A' in turn until their singular values stand, each time made
orthogonal by a QR factorisation of tall matrices.  A pass costs the same whatever
the number of concepts asked of it, and no step is of columns times columns.  Where
the vectors as a table of all columns are small they go to the tasks; else the basis is
of the rows' side, and the columns' vectors are made in tasks by blocks (``row_groups``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.scratch import checkpointed
from .ranking import top_per_group
from .reshaping import explode_array
from .row_groups import (
    block_count,
    columns_factor,
    columns_of_groups,
    cut_groups,
    factor_of,
    gram_of_groups,
    groups_turned,
    products_of,
    residual,
    rows_of_groups,
    with_products,
)
from .sparse_rows import as_doubles, cells, gram_times, matrix_of, matrix_rows, r_factor, summed, times_frame, times_table, turned
from .terms import term_frequency, tfidf

# Bytes of a table of all columns that may go to the driver and to every task.
TABLE_BYTES = 64 << 20
# Rows of a table that become a frame at a time.
TABLE_ROWS = 4_096
SEED = 20240229
# Blocks of columns that are kept from pass to pass.
KEPT_BLOCKS = 6


@dataclass(frozen=True)
class Decomposition:
    """A ~ U S V': singular values, and the rows of V (term_id, vector) and U (key, vector) as frames.

    Where V over S went to the tasks as a table, ``table`` is that.
    """

    sigma: np.ndarray
    terms: DataFrame
    documents: DataFrame
    key: str
    table: np.ndarray | None = None

    def beside(self, rows: DataFrame) -> DataFrame:
        """Rows of the matrix (key, terms, weights, ...) that have a key, each with its vector of U.

        Of a table the vectors are made anew beside the rows, and U is not written anywhere.
        """
        keyed = rows.filter(F.col(self.key).isNotNull())
        if self.table is not None:
            return times_table(keyed, self.key, self.table, [c for c in rows.columns if c not in (self.key, "terms", "weights")])
        return keyed.join(self.documents.dropDuplicates([self.key]), self.key)

    def singular_values(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(s)) for i, s in enumerate(self.sigma)]
        return spark.createDataFrame(rows, "concept INT, sigma DOUBLE")

    def term_weights(self) -> DataFrame:
        """(concept, term_id, weight), the entries of V."""
        rows = self.terms.select("term_id", as_doubles("vector").alias("_w"))
        return explode_array(rows, "_w", "concept", "weight", "term_id").select("concept", "term_id", "weight")

    def document_weights(self) -> DataFrame:
        """(key, concept, weight), the entries of U."""
        return vector_entries(self.documents, self.key)


def vector_entries(rows: DataFrame, key: str) -> DataFrame:
    """(key, concept, weight) of (key, vector)."""
    return explode_array(rows.select(key, as_doubles("vector").alias("_w")), "_w", "concept", "weight", key)


def document_rows(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", min_tokens: int = 2, max_terms: int | None = None) -> DataFrame:
    """(key, terms, weights): one sparse TF-IDF row per document, terms in order.

    Term numbers and inverse frequencies are joined to the counts, so the
    vocabulary may be of any size.  Documents with too few tokens, or without a
    term of the vocabulary, have empty rows.
    """
    return rows_of_entries(docs, document_entries(docs, vocab, key, min_tokens, max_terms), key)


def document_entries(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", min_tokens: int = 2, max_terms: int | None = None) -> DataFrame:
    """(key, _e): the TF-IDF entries (term_id, weight) of every key that has some, one row a key."""
    entries = tfidf(term_frequency(docs, key, min_tokens), vocab, key, max_terms)
    return entries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term_id", "weight"))).alias("_e"))


def rows_of_entries(docs: DataFrame, listed: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, terms, weights) of each document, of entries per key."""
    both = docs.select(key).join(listed, key, "left")
    terms = F.coalesce(F.col("_e.term_id"), F.array().cast("array<bigint>"))
    weights = F.coalesce(F.col("_e.weight"), F.array().cast("array<double>"))
    return both.select(key, terms.alias("terms"), weights.alias("weights"))


def _as_rows(rows: DataFrame, key: str, column: str, keep: Sequence[str] = ()) -> DataFrame:
    return rows.select(key, "terms", "weights", *keep) if "terms" in rows.columns else matrix_rows(rows, key, column, keep)


def column_count(rows: DataFrame) -> int:
    """One more than the largest column number."""
    return int(rows.agg(F.max(F.array_max("terms"))).first()[0] or -1) + 1


def gramian_entries(rows: DataFrame, terms: int | None = None, key: str = "doc_id", column: str = "weights") -> DataFrame:
    """(i, j, value) of A'A for i <= j; sums of each row's products, added up per i in tasks and then by Spark."""
    rows = _as_rows(rows, key, column)
    terms = terms or column_count(rows)
    sums = gram_times(rows, np.eye(terms))
    filled = _numbers(rows.sparkSession, terms).join(sums, "term_id", "left")
    values = filled.select(F.col("term_id").cast("int").alias("i"), F.coalesce("vector", F.lit(np.zeros(terms).tobytes())).alias("vector"))
    cells = explode_array(values.select("i", as_doubles("vector").alias("_v")), "_v", "j", "value", "i")
    return cells.filter("i <= j").select("i", F.col("j").cast("int").alias("j"), "value")


def _numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "term_id")


def _frame_of(spark: SparkSession, table: np.ndarray) -> DataFrame:
    """(term_id, vector) of a small table."""
    made = None
    for start in range(0, max(len(table), 1), TABLE_ROWS):
        part = table[start : start + TABLE_ROWS]
        columns = {"term_id": pa.array(np.arange(start, start + len(part))), "vector": pa.array([r.tobytes() for r in part], pa.binary())}
        frame = spark.createDataFrame(pa.table(columns))
        made = frame if made is None else made.unionByName(frame)
    return made


def _table_of(vectors: DataFrame, terms: int) -> np.ndarray:
    """The table of a frame (term_id, vector) of checked size; columns without a vector are zero."""
    found = vectors.select("term_id", "vector").toArrow()
    part = matrix_of(found.column("vector").combine_chunks())
    table = np.zeros((terms, part.shape[1]))
    table[found.column("term_id").to_numpy()] = part
    return table


def _signs(terms: DataFrame) -> np.ndarray:
    """Per concept, the sign of its largest term weight, and +1 for none."""

    def largest(batches):
        best = None
        for batch in batches:
            part = matrix_of(batch.column(0))
            if len(part):
                part = part if best is None else np.concatenate([best[None], part])
                best = part[np.abs(part).argmax(axis=0), np.arange(part.shape[1])]
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(best))), pa.array(best)], ["concept", "weight"])

    found = terms.select("vector").mapInArrow(largest, "concept bigint, weight double")
    found = found.groupBy("concept").agg(F.max_by("weight", F.abs("weight")).alias("weight")).orderBy("concept").toArrow()
    return np.where(found.column("weight").to_numpy() < 0, -1.0, 1.0)


def width_for(k: int, terms: int) -> int:
    """Vectors used for ``k`` concepts: some more, or all columns where these are hardly more."""
    width = k + max(20, min(3 * k + 20, 200))
    return terms if 2 * width >= terms else width


def truncated_svd(
    rows: DataFrame,
    k: int,
    key: str = "doc_id",
    column: str = "weights",
    r_cond: float = 1e-9,
    method: str = "auto",
    terms: int | None = None,
    passes: int = 40,
    tolerance: float = 1e-8,
) -> Decomposition:
    """The ``k`` largest singular values above ``r_cond`` times the largest, with U and V.

    ``rows`` is (key, terms, weights), or has a vector ``column``; it is read once a
    pass, so keep it.  Passes end when none of the ``k`` values changes by more than
    ``tolerance`` times the largest.  With about as many vectors as columns there
    is one pass, and the result is exact.  ``method`` is ``table`` or ``blocks`` (see
    the module), or ``auto``: table if that has at most ``TABLE_BYTES``.  Each
    concept is signed so that its largest term weight is positive.
    """
    rows = _as_rows(rows, key, column)
    terms = column_count(rows) if terms is None else terms
    width = width_for(min(k, terms), terms)
    if method == "auto":
        method = "table" if terms * width * 8 <= TABLE_BYTES else "blocks"
    if method == "table":
        return _svd_by_table(rows, k, key, r_cond, terms, width, passes, tolerance)
    if method != "blocks":
        raise ValueError(f"unknown method: {method}")
    return _svd_by_blocks(rows, k, key, r_cond, terms, width, passes, tolerance)


def _stands(values: np.ndarray, before: np.ndarray | None, k: int, tolerance: float) -> bool:
    if before is None or len(values) != len(before):
        return False
    return bool(np.abs(values[:k] - before[:k]).max(initial=0) <= tolerance * values.max(initial=0))


def _leading_basis(rows, k, terms, width, passes, tolerance) -> np.ndarray:
    """Orthogonal columns that span the leading right singular vectors.

    Each pass multiplies the newest columns by A'A; the values are those of A'A
    within all columns so far, of which the best are kept when they get many.
    """
    new = np.linalg.qr(np.random.default_rng(SEED).standard_normal((terms, width)))[0]
    basis = image = np.zeros((terms, 0))
    before = None
    for _ in range(passes):
        image = np.concatenate([image, _table_of(gram_times(rows, new), terms)], axis=1)
        basis = np.concatenate([basis, new], axis=1)
        squares, turn = np.linalg.eigh(basis.T @ image)
        best = turn[:, ::-1][:, :width]
        values = np.sqrt(np.clip(squares[::-1], 0, None))[:width]
        if _stands(values, before, k, tolerance):
            break
        before = values
        new = image[:, -new.shape[1] :]
        if basis.shape[1] + width > min(terms, KEPT_BLOCKS * width):
            basis, image = basis @ best, image @ best
            new = image
        for _ in range(2):  # once more for the rounding of the first
            new = new - basis @ (basis.T @ new)
            new = np.linalg.qr(new)[0]
    return basis @ turn[:, ::-1][:, :width] if basis.shape[1] == len(turn) else basis


def _svd_by_table(rows, k, key, r_cond, terms, width, passes, tolerance) -> Decomposition:
    basis = np.eye(terms) if width >= terms else _leading_basis(rows, k, terms, width, passes, tolerance)
    r = r_factor(rows, table=basis)
    _, sigma, turn = np.linalg.svd(r if len(r) else np.zeros((1, basis.shape[1])), full_matrices=False)
    kept = (sigma > r_cond * sigma.max(initial=0))[:k]
    sigma = sigma[:k][kept]
    v = basis @ turn[:k][kept].T
    v *= np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0) if v.size else 1.0
    return Decomposition(sigma, _frame_of(rows.sparkSession, v), times_table(rows, key, v / sigma).select(key, "vector"), key, v / sigma)


def _repeats_added(rows: DataFrame, key: str) -> DataFrame:
    """The rows that have a key; rows of equal keys each have the sum of theirs, which are equal."""
    number = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    if number.filter((F.col("_times") > 1) | F.col(key).isNull()).isEmpty():
        return rows
    return rows.join(number, key).select(key, "terms", F.transform("weights", lambda w: w * F.col("_times")).alias("weights"))


def _svd_by_blocks(rows, k, key, r_cond, terms, width, passes, tolerance) -> Decomposition:
    """The basis is of the rows' side: blocks of vectors, each A A' times the one before less what that has of all blocks."""
    rows = _repeats_added(rows, key)
    step = width if width >= terms else -(-width // 4)
    blocks = block_count(rows, terms, max(step, min(k + 8, width)))
    cut = checkpointed(cut_groups(rows, key, blocks, step))
    left = checkpointed(residual([], [], cut.filter("block = -1").select("part", "vector"), step, None), free=True)
    parts, widths, spread, squares, turn, before, least = [], [], np.zeros((0, 0)), np.zeros((0, 0)), None, None, 0.0
    for last in range(passes, 0, -1):
        _, size, own = np.linalg.svd(factor_of(left, step), full_matrices=False)
        some = size > max(1e-12 * size.max(initial=0), least)
        if not some.any():  # the basis spans all that it can
            break
        known, own = spread.shape[1], own[some].T / size[some]  # the basis is the parts, side by side, times spread
        spread = np.block([[spread, np.zeros((len(spread), own.shape[1]))], [np.zeros((step, known)), own]])
        parts.append(left)
        widths.append(step)
        if not known and (step == width or own.shape[1] < step):
            break
        step = own.shape[1]
        image = gram_of_groups(cut, groups_turned([left], widths[-1:], own), blocks, terms, step)
        image = checkpointed(with_products(parts, widths, image, step), free=True)
        products = products_of(image, step)
        shared, least = spread.T @ products[: len(spread)], 1e-8 * np.sqrt(np.trace(products[len(spread) :]))
        squares = np.block([[squares, shared[:known]], [shared[:known].T, (shared[known:] + shared[known:].T) / 2]])
        values, turn = np.linalg.eigh(squares)
        values, turn = np.sqrt(np.clip(values[::-1], 0, None))[:width], turn[:, ::-1]
        if last == 1 or _stands(values, before, k, tolerance):
            break
        before = values if len(values) >= min(k, terms) else None
        left = checkpointed(residual(parts, widths, image, step, spread @ shared), free=True)
        if len(squares) + step > KEPT_BLOCKS * width:  # only the best go on
            parts, widths = [checkpointed(groups_turned(parts, widths, spread @ turn[:, :width]), free=True)], [width]
            spread, squares, turn = np.eye(width), np.diag(values**2), np.eye(width)
    if not parts:
        none = F.lit(b"").alias("vector")
        return Decomposition(np.zeros(0), _numbers(rows.sparkSession, terms).select("term_id", none), rows.select(key, none), key)
    turn = spread if turn is None else spread @ turn[:, : k + 8]
    wide = turn.shape[1]
    best = checkpointed(groups_turned(parts, widths, turn), free=True)
    _, sigma, turn = np.linalg.svd(columns_factor(cut, best, blocks, terms, wide), full_matrices=False)
    kept = (sigma > r_cond * sigma.max(initial=0))[:k]
    sigma, turn = sigma[:k][kept], turn[:k][kept].T
    v = checkpointed(columns_of_groups(cut, best, blocks, terms, wide, turn / sigma), free=True)
    signs = _signs(v)
    documents = checkpointed(rows_of_groups(cut, groups_turned([best], [wide], turn * signs), key, len(sigma)), free=True)
    return Decomposition(sigma, turned(v, "vector", np.diag(signs), ["term_id"]), documents, key)


def project(
    rows: DataFrame, terms: DataFrame, sigma: np.ndarray, key: str = "doc_id", column: str = "weights", method: str = "auto", keep: Sequence[str] = ()
) -> DataFrame:
    """(key, ...keep, vector): the rows of U = A V S^-1 for a given V (term_id, vector).

    V goes to the tasks only if it was measured to have at most ``TABLE_BYTES``
    (``method`` table), else it is joined by blocks of terms (blocks).
    """
    rows = _as_rows(rows, key, column, keep)
    width = len(sigma)
    if method == "auto":
        last = terms.agg(F.max("term_id")).first()[0]
        method = "table" if ((last or 0) + 1) * width * 8 <= TABLE_BYTES else "blocks"
    if method == "table":
        size = max(column_count(rows), column_count(terms.select(F.array("term_id").alias("terms"))))
        product = times_table(rows, key, _table_of(terms, size), keep)
    else:
        product = times_frame(rows, key, terms, width, keep=keep)
    return turned(product, "vector", np.diag(1 / np.asarray(sigma)), [key, *keep])


def rebuilt(svd: Decomposition, method: str = "auto") -> DataFrame:
    """(key, term_id, value): all cells of U S V'; rows of equal keys add up.

    V goes to the tasks only if it was measured to have at most ``TABLE_BYTES``
    (``method`` table), else rows meet it in blocks (blocks).
    """
    width = len(svd.sigma)
    if method == "auto":
        method = "table" if svd.terms.count() * width * 8 <= TABLE_BYTES else "blocks"
    rows = turned(svd.documents, "vector", np.diag(svd.sigma), [svd.key])
    return cells(summed(rows, svd.key), svd.key, svd.terms, width, method == "table")


def heaviest_documents(documents: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The entries of (key, vector) that can be among the top ``n`` of their concept.

    Each task keeps its own ``n`` best documents per concept while it reads, so
    the documents-by-concepts table is never written out or sorted.  Equal
    weights go to the lower key.
    """

    def best(batches):
        keys = weights = kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field(0).type
            new = matrix_of(batch.column(1))
            own = np.repeat(batch.column(0).to_numpy(zero_copy_only=False)[:, None], new.shape[1], axis=1)
            keys = own if keys is None else np.concatenate([keys, own])
            weights = new if weights is None else np.concatenate([weights, new])
            order = np.lexsort((keys, -weights), axis=0)[:n]
            keys, weights = np.take_along_axis(keys, order, 0), np.take_along_axis(weights, order, 0)
        if keys is not None:
            concept = np.tile(np.arange(weights.shape[1], dtype=np.int32), len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel(), kind), pa.array(concept), pa.array(weights.ravel())], [key, "concept", "weight"])

    return documents.select(key, "vector").mapInArrow(best, f"{key} {dict(documents.dtypes)[key]}, concept int, weight double")


def top_terms(weights: DataFrame, vocab: DataFrame, n: int) -> DataFrame:
    """(concept, rank, term, weight): the heaviest terms of each concept."""
    best = top_per_group(weights, "concept", n, [F.desc("weight"), F.col("term_id")])
    return best.join(vocab.select("term_id", "term"), "term_id").select("concept", "rank", "term", "weight")


def top_documents(weights: DataFrame, titles: DataFrame, n: int, key: str = "doc_id", title: str = "title") -> DataFrame:
    """(concept, rank, key, title, weight): the heaviest documents of each concept.

    The ranked rows, at most ``n`` per concept, are what is broadcast.
    """
    best = top_per_group(weights, "concept", n, [F.desc("weight"), F.col(key)])
    return titles.select(key, title).join(F.broadcast(best), key).select("concept", "rank", key, title, "weight")
