"""Document fingerprints by consistent weighted sampling.

A document's terms are its pairs of neighbouring words (with a mark before the
first and after the last word), weighted by their counts.  Its fingerprint is
``SAMPLES`` samples of 16 bits; the share of equal samples of two fingerprints
estimates the generalised Jaccard similarity of the weighted terms.

Defined cases: a null text is empty, and the empty text has a fingerprint like
any other; a long text is hashed whole, in a block of its own; repeated rows each
have theirs; rows with a null id come first; equal ids are ordered by text; no
documents give no rows; a column with the name of a result is replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import BLOCK_BYTES, WORD_BYTES, Block, blocks, make_room, map_blocks, text_bytes
from tidemark.llm.sampling import Sampler, count_terms

SAMPLES = 128
#: Bytes of text that one part of the ordered documents holds, on average.
PART_BYTES = 128 << 20
_BEGIN, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def word_pairs(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each pair of neighbouring words, with marks at the ends."""
    words, _, _, doc = block.tokens(WORD_BYTES)
    at = np.arange(len(words)) + doc
    left = np.full(len(words) + len(block), _BEGIN)
    right = np.full(len(words) + len(block), _END)
    left[at + 1], right[at] = words, words
    sizes = np.bincount(doc, minlength=len(block)) + 1
    return np.repeat(np.arange(len(block)), sizes), left * np.uint64(0x9E3779B97F4A7C15) + right


def sketch(texts: list[bytes], sampler: Sampler) -> np.ndarray:
    """documents x samples of uint16."""
    out = []
    for block in blocks(texts):
        doc, term, count = count_terms(*word_pairs(block))
        out.append(sampler.samples(doc, term, count.astype(np.float64), len(block)).astype(np.uint16))
    return np.concatenate(out) if out else np.zeros((0, len(sampler.odd)), np.uint16)


def fingerprints(docs: DataFrame, text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``docs`` plus fingerprint (hex); one pass, no shuffle."""
    docs = make_room(docs, "fingerprint")
    own = docs.columns
    held = [f"c{i}" for i in range(len(own))]
    renamed = docs.toDF(*held).withColumn("__text_bytes", text_bytes(held[own.index(text)]))

    def make():
        sampler = Sampler(samples)
        return lambda block: {"fingerprint": [row.tobytes().hex() for row in sketch(block.texts, sampler)]}

    return map_blocks(renamed, "__text_bytes", make, "fingerprint string", held).toDF(*own, "fingerprint")


def likeness(left: str, right: str):
    """The share of equal samples of two fingerprint columns; a column expression."""
    size = (F.length(left) / 4).cast("int")
    equal = F.filter(F.sequence(F.lit(0), size - 1), lambda k: F.substring(left, k * 4 + 1, F.lit(4)) == F.substring(right, k * 4 + 1, F.lit(4)))
    return F.size(equal) / size


def _in_order(docs: DataFrame, doc_id: str, text: str, parts: int) -> DataFrame:
    """(part, guest, doc_id, text) sorted within parts by id; the document after a part's last is its guest.

    The parts are ranges of ids; only the parts' first ids, one a part, pass the driver.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rank = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("double")
    ids = rows.select(rank.alias("rank"))
    cuts = ids.approxQuantile("rank", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    splits = [-float("inf"), *(sorted(set(cuts or [])) or [0.0]), float("inf")]
    part_of = Bucketizer(splits=splits, inputCol="rank", outputCol="part")
    firsts = part_of.transform(ids).groupBy("part").agg(F.min("rank").alias("rank")).orderBy("part").collect()
    if not firsts:
        return rows.select(F.lit(0).alias("part"), F.lit(0).alias("guest"), "doc_id", "text")
    before = [(r["rank"], int(firsts[k - 1]["part"])) for k, r in enumerate(firsts)]
    hosts = F.broadcast(docs.sparkSession.createDataFrame(before, "rank double, host int"))
    placed = part_of.transform(rows.withColumn("rank", rank)).withColumn("part", F.col("part").cast("int"))
    placed = placed.join(hosts, "rank", "left")
    seats = F.array(F.struct(F.col("part"), F.lit(0).alias("guest")), F.struct(F.col("host").alias("part"), F.lit(1).alias("guest")))
    seats = F.filter(seats, lambda s: s["part"].isNotNull())
    seated = placed.select("doc_id", "text", F.explode(seats).alias("seat")).select("seat.part", "seat.guest", "doc_id", "text")
    spread = seated.repartition(parts, "part")
    return spread.sortWithinPartitions("part", "guest", F.asc_nulls_first("doc_id"), "text")


def parts_for(docs: DataFrame, text: str, part_bytes: int = PART_BYTES) -> int:
    """As many parts as the texts need, and no fewer than the session shuffles into."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string"))).alias("size")).first()["size"] or 0
    return max(-(-size // part_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES, parts: int | None = None) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and its likeness to that and to the next document.

    The edited text is the document with its last floor(n_chars / 2) code points
    replaced by the first as many (or all) of the next document by id; after the
    last comes the first.  Whole texts are shuffled once, by ranges of ids.
    """
    parts = parts or parts_for(docs, text)
    ordered = _in_order(docs, doc_id, text, parts)
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)

        def answer(rows: list[tuple], following: str) -> pa.RecordBatch:
            texts = [r[1] for r in rows]
            after = [*texts[1:], following]
            edited = [(t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode() for t, n in zip(texts, after, strict=True)]
            own = sketch([t.encode() for t in [*texts, following]], sampler)
            other = sketch(edited, sampler)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
                    "fingerprint": [x.tobytes().hex() for x in own[:-1]],
                    "edited_fingerprint": [x.tobytes().hex() for x in other],
                    "near_edited": (own[:-1] == other).mean(axis=1),
                    "near_next": (own[:-1] == own[1:]).mean(axis=1),
                }
            )

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        waiting: list[tuple] = []
        size, part, closed = 0, None, False
        for p, guest, i, t in rows():
            if p != part:
                part, closed = p, False
            if closed:
                continue  # guests after the first
            if guest or size > BLOCK_BYTES or len(waiting) >= 1000:
                if waiting:
                    yield answer(waiting, t)
                waiting, size, closed = [], 0, bool(guest)
            if not guest:
                waiting.append((i, t))
                size += len(t)

    return ordered.mapInArrow(task, schema)


def query(spark, folder: str) -> DataFrame:
    return with_next(spark.read.parquet(f"{folder}/documents.parquet"))
