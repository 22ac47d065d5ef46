"""Removing passages that an earlier document has, by relative Lempel-Ziv parsing.

Words are the runs of ``VISIBLE_BYTES``, unchanged; a window is ``WINDOW`` of them
in a row.  A document is parsed greedily against the reference blocks: a factor is
the longest passage, from the present word on, that follows one occurrence in a
document of a smaller id.  Factors of a window or more are duplicate spans.  A
window can also lie across the end of a factor and occur elsewhere, so every
window that a factor's end cuts is looked up too.

Texts that are equal are one text, of the least of their ids; the others are
copies as a whole.  Where a text can match at all is found first:

1. Of each window the ``ANCHOR`` words of least rank are its anchor.  Equal windows
   have equal anchors, so a window whose anchor occurs in one document only is unique.
2. Anchors of two documents or more are dealt by rank, with names of all their
   windows.  What a task reads of them, some whole ranks at a time, is a reference
   block: its windows are indexed and the passages in it are parsed against it.  As
   an anchor's windows are all in one block, blocks need not meet.
3. An anchor that more than ``CROWD`` texts share is dealt by whole windows instead,
   and a task deals a window only while no text of smaller id had it there, so a
   crowd is a few rows a task.

A window's name is a 64-bit hash of its words, and counts only within equal
64-bit ranks of the anchor in it.

Defined cases: null and empty texts have no words; a document with a null id is
neither smaller nor larger than another, so nothing of it is removed and it is
nobody's reference; the same holds between rows of one id, repeated or not; texts
of fewer words than a window keep all; an empty table has no rows.  Very long
texts are handled whole, in pieces where they are ranked.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import AS_IS, VISIBLE_BYTES, Block, blocks, bounds, mix, text_bytes
from tidemark.operators.lookups import lookup_join
from tidemark.sources.scratch import checkpointed, scratch_path

WINDOW = 13
ANCHOR = 5
#: Texts that may share an anchor before its windows are dealt one by one.
CROWD = 4_000
#: Words ranked at once.
PIECE = 1 << 20
#: Windows of a reference block, about; whole ranks only.
BLOCK = 1 << 17
#: Windows of crowds that a task remembers.
HELD_WINDOWS = 1 << 20
#: Bytes of text for each part of the table of texts.
PART_BYTES = 64 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.uint64((1 << 24) - 1)


def gram_ranks(words: np.ndarray, n: int) -> np.ndarray:
    """A rank for every ``n`` words in a row."""
    size = len(words) - n + 1
    rank = words[:size]
    for k in range(1, n):
        rank = mix(rank * _ODD + words[k : k + size])
    return rank


def anchors(words: np.ndarray, doc: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(document, position, rank, first and last window start) of the anchors; positions count in ``words``."""
    parts = []
    width = window - anchor + 1
    for at in range(0, len(words) - window + 1, PIECE):
        piece, owner = words[at : at + PIECE + window - 1], doc[at : at + PIECE + window - 1]
        rank = gram_ranks(piece, anchor)
        least = (rank & ~_PLACES) | np.arange(len(rank), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: span - width], least[width - span :])
        start = np.flatnonzero(owner[: len(least)] == owner[window - 1 :])
        where = (least[start] & _PLACES).astype(np.int64)
        new = bounds(where)
        last = np.append(new[1:], len(where)) - 1
        if len(new):
            parts.append((owner[start[new]], where[new] + at, rank[where[new]], start[new] + at, start[last] + at))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _texts(docs: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (t, least, copies, packed), and rows (doc_id, t) of all documents.

    The texts are a table in buckets of t, so that joins by t leave them where they
    are.  Copies are dropped in the task that reads them, so a crowd of them is a row a
    task.  Should two texts get one number t, all are numbered anew.
    """
    size = docs.select(F.octet_length("text").cast("bigint").alias("n")).agg(F.sum("n")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    names = ["t", "name", "least", "copies", "packed"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        seen: dict[tuple, list] = {}
        for batch in batches:
            out = []
            for doc_id, raw, t, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (t, name) in seen:
                    was = seen[t, name]
                    was[0] = min((i for i in (was[0], doc_id) if i is not None), default=None)
                    was[1] += 1
                else:
                    seen[t, name] = [None, 0]
                    out.append((t, name, doc_id, 1, tool.compress(raw)))
            yield as_batch(out)
        yield as_batch([(t, name, least, n, None) for (t, name), (least, n) in seen.items() if n])

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    for seed in count():
        rows = docs.select("doc_id", text_bytes("text").alias("raw")).withColumn("t", F.xxhash64(F.lit(seed), "raw"))
        dealt = rows.withColumn("name", F.unhex(F.md5("raw"))).mapInArrow(press, "t bigint, name binary, least bigint, copies bigint, packed binary")
        first = F.first("packed", ignorenulls=True)
        texts = dealt.repartition(parts, "t").groupBy("t").agg(
            F.min("least").alias("least"), F.sum("copies").alias("copies"), first.alias("packed"), F.min("name").alias("name"), F.max("name").alias("other")
        )
        path = scratch_path(docs.sparkSession, table)
        texts.write.bucketBy(parts, "t").option("path", path).option("compression", "none").mode("overwrite").saveAsTable(table)
        texts = docs.sparkSession.table(table)
        if texts.filter("name != other").isEmpty():
            return texts.drop("name", "other"), rows.select("doc_id", "t")


def _unpacked(batch: pa.RecordBatch) -> Iterator[Block]:
    """The whole texts of a batch, in blocks."""
    tool = zstandard.ZstdDecompressor()
    yield from blocks([tool.decompress(p) for p in batch.column(batch.schema.names.index("packed")).to_pylist()])


def _anchor_rows(texts: DataFrame, placed: bool) -> DataFrame:
    """(rank, least), or if ``placed`` (rank, t, place), of all anchors of texts with an id.

    place holds the anchor's word, and how far its windows start before it.
    """
    used = texts.filter(F.col("least").isNotNull()).select("least", "t", "packed")
    kind = "rank bigint, t bigint, place bigint" if placed else "rank bigint, least bigint"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, t = (batch.column(k).to_numpy() for k in (0, 1))
            for block in _unpacked(batch):
                words, _, _, doc = block.tokens(VISIBLE_BYTES, AS_IS)
                owner, where, rank, first, last = anchors(words, doc)
                rows = {"rank": rank.view(np.int64)}
                if placed:
                    begin = np.searchsorted(doc, owner)
                    rows |= {"t": t[block.first + owner], "place": (where - begin << 8) | (where - first << 4) | (where - last)}
                else:
                    rows |= {"least": least[block.first + owner]}
                yield pa.RecordBatch.from_pydict(rows)

    return used.mapInArrow(task, kind)


def _passages(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """(route, least, t, first, last, names, also): passages to parse, and spans without names that are known to be duplicates.

    A passage is the windows of a shared anchor, as 64-bit names, dealt by the
    anchor's rank.  In a crowd each window is a passage, dealt by itself, once a
    text, with the words (``also``) at which the text has it again; one that the
    task has met in a text of smaller id is a duplicate already.
    """
    by_text = shared.groupBy("t").agg(F.collect_list(F.struct("place", "rank")).alias("at"))
    both = texts.select("t", "least", "packed").join(by_text, "t")
    both = both.select("t", "least", F.col("at.place").alias("place"), F.col("at.rank").alias("rank"), "packed")
    names = ["route", "least", "t", "first", "last", "names", "also"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows: dict[int, int] = {}
        for batch in batches:
            t, least = (batch.column(k).to_numpy() for k in (0, 1))
            for block in _unpacked(batch):
                hashes, _, _, doc = block.tokens(VISIBLE_BYTES, AS_IS)
                window = mix(gram_ranks(hashes, WINDOW))
                rows = slice(block.first, block.first + len(block))
                places, ranks = (batch.column(c)[rows] for c in (2, 3))
                doc_of = np.repeat(np.arange(len(block)), places.value_lengths().to_numpy())
                place, rank = places.flatten().to_numpy(), ranks.flatten().to_numpy()
                begin = np.searchsorted(doc, doc_of)
                where = begin + (place >> 9)
                first, last = where - (place >> 5 & 15), where - (place >> 1 & 15)
                crowd = (place & 1).astype(bool)
                size = last - first + 1
                quiet = np.flatnonzero(~crowd)
                owner = doc_of[quiet] + block.first
                yield as_batch(rank[quiet], least[owner], t[owner], (first - begin)[quiet], size[quiet], window[from_to(first[quiet], size[quiet])])
                if not crowd.any():
                    continue
                at = from_to(first[crowd], size[crowd])
                route = mix(window[at] ^ mix(np.repeat(rank[crowd], size[crowd]).view(np.uint64)))
                owner, word = np.repeat(doc_of[crowd] + block.first, size[crowd]), at - np.repeat(begin[crowd], size[crowd])
                order = np.lexsort((word, route, owner))
                route, owner, word, at = route[order], owner[order], word[order], at[order]
                head = np.ones(len(order), bool)
                head[1:] = (route[1:] != route[:-1]) | (owner[1:] != owner[:-1])
                deal = np.array([met(lows, r, low) for r, low in zip(route[head].tolist(), least[owner[head]].tolist(), strict=True)])
                dealt = deal[np.cumsum(head) - 1]
                one, others = head & dealt, ~head & dealt
                more = np.bincount((np.cumsum(one) - 1)[others], minlength=one.sum())
                mine = owner[one]
                yield as_batch(route[one].view(np.int64), least[mine], t[mine], word[one], np.ones(len(mine), np.int64), window[at[one]], None, more, word[others])
                mine, word = owner[~dealt], word[~dealt]
                order = np.lexsort((word, mine))
                mine, word = mine[order], word[order]
                new = np.ones(len(mine), bool)
                new[1:] = (mine[1:] != mine[:-1]) | (word[1:] > word[:-1] + WINDOW)
                mine, stop = mine[new], word[np.append(np.flatnonzero(new)[1:], len(word)) - 1] + WINDOW if len(word) else word
                yield as_batch(t[mine], least[mine], t[mine], word[new], np.zeros(len(mine), np.int64), window[:0], stop)

    def from_to(first: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def met(lows: dict[int, int], route: int, least: int) -> bool:
        """Whether a window has to be dealt: no text of smaller id had it here."""
        low = lows.get(route)
        if low is not None and low < least:
            return False
        if len(lows) > HELD_WINDOWS:
            lows.clear()
        lows[route] = least
        return True

    def lists(size: np.ndarray, values: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(8 * size)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])

    def as_batch(route, least, t, first, size, window, last=None, more=None, also=None) -> pa.RecordBatch:
        none = np.zeros(len(size), np.int64)
        columns = [pa.array(x) for x in (route, least, t, first, none if last is None else last)]
        return pa.RecordBatch.from_arrays([*columns, lists(size, window), lists(none, none[:0]) if more is None else lists(more, also)], names)

    return both.mapInArrow(task, "route bigint, least bigint, t bigint, first bigint, last bigint, names binary, also binary")


class ReferenceBlock:
    """Passages of many texts as names of windows, and an index of them: where in the text of least id each occurs."""

    def __init__(self, passages: list[bytes], route: np.ndarray, least: np.ndarray):
        self.names = np.frombuffer(b"".join(passages), np.uint64)
        size = np.fromiter((len(p) // 8 for p in passages), np.int64, len(passages))
        self.first = np.cumsum(size) - size
        self.passage = np.repeat(np.arange(len(passages)), size)
        self.names = mix(self.names ^ mix(np.repeat(route.view(np.uint64), size)))
        own = np.repeat(least, size)
        order = np.lexsort((own, self.names))
        head = np.zeros(len(order), bool)
        head[bounds(self.names[order])] = True
        source = np.empty(len(order), np.int64)
        source[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        #: By window, where it occurs in a text of smaller id; else -1.
        self.source = np.where(own[source] < own, source, -1)

    def factors(self) -> Iterator[tuple[int, int, int]]:
        """(passage, first, last word) of the factors of a window or more, and of windows that factors' ends cut.

        From the present window a factor follows its source as far as both go on
        alike; parsing goes on after it, and windows across its end are looked up.
        """
        names, passage, source = self.names, self.passage, self.source
        alike = np.zeros(len(names) + 1, bool)
        alike[1:-1] = passage[1:] == passage[:-1]
        hits = np.flatnonzero(source >= 0)
        k = 0
        while k < len(hits):
            at, follow = int(hits[k]), int(source[hits[k]])
            own, stop = int(passage[at]), k + 1
            while stop < len(hits) and hits[stop] == at + stop - k and passage[hits[stop]] == own:
                follows = follow + stop - k
                if not alike[follows] or names[follows] != names[hits[stop]]:
                    break
                stop += 1
            begin = at - int(self.first[own])
            yield own, begin, begin + stop - k - 1 + WINDOW
            k = stop

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.array(x, np.int64) for x in zip(*self.factors(), strict=True)) or (np.zeros(0, np.int64),) * 3


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of whole routes, about ``BLOCK`` windows at a time."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size > 8 * BLOCK and row[0] != held[-1][0]:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[-1]) + len(row[-2]) + 8
    if held:
        yield held


def _parsed(passages: DataFrame) -> DataFrame:
    """(t, first, last): duplicate spans of words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches):
            route, least, t, first, last = (np.array(x, np.int64) for x in list(zip(*rows, strict=True))[:5])
            which, begin, end = ReferenceBlock([r[5] for r in rows], route, least).spans()
            again = [np.frombuffer(rows[k][6], np.int64) for k in which.tolist()]
            by = which.repeat([len(x) for x in again])
            again = np.concatenate([*again, which[:0]])
            known = np.array([not r[5] for r in rows])
            parts = [(t[which], first[which] + begin, first[which] + end), (t[by], again, again + WINDOW), (t[known], first[known], last[known])]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["t", "first", "last"])

    return passages.repartition("route").sortWithinPartitions("route").mapInArrow(task, "t bigint, first bigint, last bigint")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(t, first, last): spans of words, overlapping ones included, that are in a text of smaller id."""
    met = _anchor_rows(texts, placed=False).groupBy("rank").agg(F.min("least").alias("low"), F.max("least").alias("high"), F.count(F.lit(1)).alias("n"))
    met = checkpointed(met.filter("low < high").select("rank", (F.col("n") > CROWD).cast("bigint").alias("crowd")))
    shared = _anchor_rows(texts, placed=True).join(met, "rank").select("t", (F.col("place") * 2 + F.col("crowd")).alias("place"), "rank")
    return _parsed(_passages(texts, shared))


def _judged_texts(texts: DataFrame, with_text: bool) -> DataFrame:
    """(t, least, copies, n_words, n_removed, whole_sha256, kept_sha256, whole, kept) per distinct text."""
    spans = repeated_spans(texts).groupBy("t").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    both = texts.join(spans, "t", "left").select("t", "least", "copies", "spans", "packed")
    names = ["t", "least", "copies", "n_words", "n_removed", "whole_sha256", "kept_sha256", "whole", "kept"]
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.binary(), pa.binary()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _unpacked(batch):
                out = []
                for k, text in enumerate(block.texts):
                    t, least, copies, spans = (batch.column(c)[block.first + k].as_py() for c in range(4))
                    words = text.split()
                    whole = kept = b" ".join(words)
                    left = len(words)
                    if spans:
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, [s["first"] for s in spans], 1)
                        np.add.at(gone, [s["last"] for s in spans], -1)
                        stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                        left, kept = len(stay), b" ".join([words[i] for i in stay])
                    sums = [hashlib.sha256(x).hexdigest() for x in (whole, kept)]
                    out.append((t, least, copies, len(words), len(words) - left, *sums, *((whole, kept) if with_text else (None, None))))
                yield pa.RecordBatch.from_arrays([pa.array(x, c) for x, c in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "t bigint, least bigint, copies bigint, n_words bigint, n_removed bigint, whole_sha256 string, kept_sha256 string, whole binary, kept binary"
    return both.mapInArrow(task, schema)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per document, and kept: the words that stay, joined by spaces."""
    spark, table = docs.sparkSession, f"relative_parse_{uuid.uuid4().hex}"
    try:
        texts, rows = _texts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), table)
        found = _judged_texts(texts, with_text)
        found = checkpointed(found if with_text else found.drop("whole", "kept"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # its files stay in the shared folder, like checkpoints
    hot = found.filter(F.col("copies") * 1000 >= rows.count()).select("t")
    both = lookup_join(rows, found, "t", hot=hot, salt_by=["doc_id"])
    # a copy of a text with a smaller id goes whole, if it has a window
    copy = F.coalesce((F.col("doc_id") > F.col("least")) & (F.col("n_words") >= WINDOW), F.lit(False))
    out = {
        "n_words": F.col("n_words"),
        "n_removed": F.when(copy, F.col("n_words")).when(F.col("doc_id").isNull(), 0).otherwise(F.col("n_removed")),
        "kept_sha256": F.when(copy, hashlib.sha256(b"").hexdigest()).when(F.col("doc_id").isNull(), F.col("whole_sha256")).otherwise(F.col("kept_sha256")),
    }
    if with_text:
        out["kept"] = F.when(copy, "").when(F.col("doc_id").isNull(), F.col("whole").cast("string")).otherwise(F.col("kept").cast("string"))
    return both.select("doc_id", *[c.alias(n) for n, c in out.items()])


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, with_text=False)


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, row, i AS pos, array_to_string(w[i:i + 12], ' ') AS phrase FROM docs, unnest(range(1, len(w) - 11)) AS u(i)
), hits AS (
  SELECT row, pos FROM (SELECT row, pos, doc_id, min(doc_id) OVER (PARTITION BY phrase) AS least FROM windows) WHERE least < doc_id
), gone AS (SELECT DISTINCT row, pos + k AS pos FROM hits, unnest(range(0, 13)) AS u(k)
), kept AS (
  SELECT d.row, count(g.pos) AS n_removed, coalesce(string_agg(d.word, ' ' ORDER BY d.pos) FILTER (g.pos IS NULL), '') AS kept
  FROM (SELECT row, i AS pos, w[i] AS word FROM docs, unnest(range(1, len(w) + 1)) AS u(i)) d LEFT JOIN gone g USING (row, pos) GROUP BY d.row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)
"""
