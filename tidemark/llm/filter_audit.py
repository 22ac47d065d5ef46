"""How document filters interact, over every order in which they can be applied.

A document is known by its mask: one bit for each filter that it fails, and two
more for a good and for a toxic label.  A mask decides the outcome of all steps
of all orders, so it is mapped to one big integer with a field of ``FIELD_BITS``
bits for each outcome of each step.  Integers are added up per part, first inside
tasks, then by Spark, and the sums' fields are the counts.  A field holds any
count below 2^64, so none runs into the next one.

Defined cases: a null or empty text has no words and is judged like others (it
fails A, and E if a smaller id has no text either); a null id is never larger or
smaller than another, and has no label; of repeated rows none is the smaller one;
rows of one id and different texts are documents each; a document with several
labels counts as good, or toxic, if one says so; a null part is the part '';
an empty table has no parts and no rows.  Columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import AS_IS, VISIBLE_BYTES, Block, map_blocks, text_bytes
from tidemark.operators.lookups import lookup_join
from tidemark.sources.scratch import checkpointed

FIELD_BITS = 64
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Parts whose sums a task holds at once.
HELD_PARTS = 512
#: Tasks whose sums of one part meet in so many places before they meet in one.
SALTS = 32

MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*|")] = True


def text_failures(block: Block) -> np.ndarray:
    """Per document, bits of the failed filters A to D."""
    hashes, _, _, doc = block.tokens(VISIBLE_BYTES, AS_IS)
    words = np.bincount(doc, minlength=len(block))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    distinct = np.bincount(doc[new], minlength=len(block))
    raw = np.frombuffer(block.data, np.uint8)

    def per_document(kind: np.ndarray) -> np.ndarray:
        return np.add.reduceat(kind, block.starts, dtype=np.int64)

    points = per_document((raw & 0xC0) != 0x80) - 1  # without the line end that joins texts
    few = words < MIN_WORDS
    same = 100 * distinct < MIN_DISTINCT * words
    loud = 100 * per_document(_CAPITAL[raw]) > MAX_CAPITALS * points
    odd = per_document(_SYMBOL[raw]) > 0
    return few | (same << 1) | (loud << 2) | (odd << 3)


def masks(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic) per document, for the filters A to E."""
    raw = text_bytes(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), raw.alias("raw"))
    rows = rows.withColumn("name", F.md5("raw"))

    def make():
        return lambda block: {"mask": text_failures(block).astype(np.int32)}

    rows = checkpointed(map_blocks(rows, "raw", make, "mask int", ["doc_id", "part", "name"]))
    same = rows.groupBy("name").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"))
    same = checkpointed(same.filter("least < most"))
    hot = same.filter(F.col("n") * 1000 >= rows.count()).select("name")
    rows = lookup_join(rows, same.select("name", "least"), "name", "left", hot=hot)
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    rows = rows.select("doc_id", "part", (F.col("mask") + 16 * later).alias("mask"))
    good, toxic = F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    marked = labels.filter("quality = 1 OR toxic = 1").groupBy(F.col(doc_id).alias("doc_id")).agg(good, toxic)
    rows = lookup_join(rows, checkpointed(marked), "doc_id", "left", costly_left=True)
    return rows.select("part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def packed_outcomes(filters: str) -> list[int]:
    """By mask, with two more bits for good and toxic: the integer of all outcomes of all steps."""
    k = len(filters)
    orders = np.array(list(permutations(range(k))))
    out = []
    for kind in range(4 << k):
        fails = (kind >> orders) & 1
        before = (np.cumsum(fails, axis=1) - fails) > 0
        removed = (fails == 1) & ~before
        alone = (kind & ((1 << k) - 1)) == (1 << orders)
        good, toxic = kind >> k & 1, kind >> (k + 1) & 1
        fields = [(fails == 0) & ~before, removed, (fails == 1) & before, alone, removed & (good == 1), removed & (toxic == 1)]
        out.append(int.from_bytes(np.stack(fields, axis=-1).astype("<u8").tobytes(), "little"))
    return out


def audit(marked: DataFrame, filters: str = "ABCDE", part: str = "part", mask: str = "mask", good: str = "good", toxic: str = "toxic") -> DataFrame:
    """A row per part, order of the filters and step, with the counts of ``OUTCOMES`` and shapley.

    Bit i of ``mask`` says that the document fails ``filters[i]``.  shapley is the
    number that the step's filter removes, added up over all orders.
    """
    k = len(filters)
    orders = list(permutations(range(k)))
    steps = len(orders) * k
    size = steps * len(OUTCOMES) * FIELD_BITS // 8
    label = {c: F.coalesce(F.col(c), F.lit(False)).cast("int") for c in (good, toxic)}
    kind = F.col(mask).cast("int") + (label[good] + 2 * label[toxic]) * (1 << k)
    rows = marked.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), kind.alias("kind"))

    def emit(totals: dict[str, int]) -> pa.RecordBatch:
        salt = TaskContext.get().partitionId() % SALTS
        names = pa.array(list(totals), pa.string())
        values = pa.array([v.to_bytes(size, "little") for v in totals.values()], pa.binary())
        return pa.RecordBatch.from_arrays([names, pa.array([salt] * len(totals), pa.int32()), values], ["part", "salt", "total"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = packed_outcomes(filters)
        totals: dict[str, int] = {}
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            code = parts.indices.to_numpy() * len(packed) + batch.column(1).to_numpy()
            names = parts.dictionary.to_pylist()
            found, n = np.unique(code, return_counts=True)
            for c, times in zip(found.tolist(), n.tolist(), strict=True):
                name = names[c // len(packed)]
                totals[name] = totals.get(name, 0) + times * packed[c % len(packed)]
            if len(totals) > HELD_PARTS:
                yield emit(totals)
                totals = {}
        if totals:
            yield emit(totals)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
        """(part, sum) of rows that are sorted by part."""
        name, total = None, 0
        for batch in batches:
            for p, value in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist(), strict=True):
                if p != name and name is not None:
                    yield name, total
                    total = 0
                name, total = p, total + int.from_bytes(value, "little")
        if name is not None:
            yield name, total

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, total in runs(batches):
            yield emit({name: total})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = ["".join(filters[f] for f in p) for p in orders for _ in range(k)]
        last = np.array(orders).ravel()
        for name, total in runs(batches):
            counts = np.frombuffer(total.to_bytes(size, "little"), "<u8").reshape(steps, len(OUTCOMES)).astype(np.int64)
            removed = np.zeros(k, np.int64)
            np.add.at(removed, last, counts[:, OUTCOMES.index("removed")])
            columns = {"part": [name] * steps, "filter_order": order, "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders))}
            yield pa.RecordBatch.from_pydict(columns | {c: counts[:, i] for i, c in enumerate(OUTCOMES)} | {"shapley": removed[last]})

    kinds = "part string, salt int, total binary"
    partial = rows.mapInArrow(count, kinds)
    near = partial.repartition("part", "salt").sortWithinPartitions("part").mapInArrow(add, kinds)
    whole = near.repartition("part").sortWithinPartitions("part")
    return whole.mapInArrow(unpack, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in (*OUTCOMES, "shapley")))


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(masks(docs, labels))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marked AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, (
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS mask
  FROM words LEFT JOIN marked USING (doc_id)
), classes AS (SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS f, filter_order[1:s - 1] AS earlier FROM orders, range(1, 6) r(s)
), judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(mask, f) AS fails, mask = f AS alone,
    earlier <> '' AND regexp_matches(mask, '[' || earlier || '_]') AS gone FROM steps, classes
), counts AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
    coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counts
"""
