"""Removing repeated byte strings by prefix doubling.

A position's rank at length h is a name of its next h bytes, and the pair of
ranks at p and p + h is its rank at 2h.  Ranks of up to 64 bytes are built inside
a task.  Then Spark groups equal ranks, drops positions whose rank is unique, and
goes on to the threshold length with what is left:

1. Of the starts of each window of ``LENGTH`` bytes only the position of least
   rank (at 64 bytes) is sent: the window's anchor.  Equal windows have equal
   anchors at equal distances, so a window whose anchor's rank is unique is
   unique, and no repeat is lost.
2. Anchors whose rank occurs at one place only drop out (equal texts count as one).
3. The others send the bytes around them to the task of their rank, where the
   windows' ranks at the full length decide: a window is a repeat if its rank
   occurs twice.  For an anchor that more than ``CROWD`` places share, the ranks
   of the windows are grouped by Spark instead, so no task gathers a crowd.

Windows are only compared within one anchor's rank, so a false match needs two
64-bit ranks to collide for texts that already share 64 bytes.

Defined cases: null and empty texts have 0 bytes and nothing removed; of
repeated rows (equal texts of at least ``LENGTH`` bytes) every byte is removed
from each; texts shorter than ``LENGTH`` keep all; no documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import bounds, mix, text_bytes
from tidemark.sources.scratch import checkpointed

LENGTH = 200
ANCHOR = 64
#: Places that may share an anchor's rank before its windows are grouped by Spark.
CROWD = 30_000
#: Bytes whose ranks a task holds at once; longer texts are ranked piece by piece.
PIECE = 1 << 20


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def ranks(raw: np.ndarray, length: int) -> np.ndarray:
    """The rank at ``length`` of every position that has so many bytes after it, by doubling."""
    h, rank = 1, mix(raw.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    while 2 * h <= length:
        rank = _pair(rank[:-h], rank[h:])
        h *= 2
    return rank if h == length else _pair(rank[: h - length], rank[length - h :])


def anchors(raw: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, rank, first and last window start) of the anchors of one text of at least ``length`` bytes."""
    parts = []
    for at in range(0, len(raw) - length + 1, PIECE):
        piece = raw[at : at + PIECE + length - 1]
        rank = ranks(piece, anchor)
        place = np.arange(len(rank), dtype=np.uint64)
        least = (rank & ~np.uint64((1 << 24) - 1)) | place
        span, width = 1, length - anchor + 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: span - width], least[width - span :])
        where = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = bounds(where)
        last = np.append(first[1:], len(where)) - 1
        parts.append((where[first] + at, rank[where[first]], first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """(key, packed) per row: a name of the text, and its bytes compressed."""
    raw = docs.select(text_bytes(text).alias("raw")).filter(F.octet_length("raw") >= LENGTH).select(F.xxhash64("raw").alias("key"), "raw")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [press.compress(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "packed": pa.array(packed, pa.binary())})

    return raw.mapInArrow(task, "key bigint, packed binary")


def _anchor_rows(docs: DataFrame, text: str) -> DataFrame:
    """(rank, key, place): place holds the anchor's position and how far its windows start before it."""
    raw = docs.select(text_bytes(text).alias("raw")).filter(F.octet_length("raw") >= LENGTH).select(F.xxhash64("raw").alias("key"), "raw")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, rank, first, last = anchors(np.frombuffer(text, np.uint8))
                place = (where << 16) | ((where - first) << 8) | (where - last)
                out.append((rank.view(np.int64), np.full(len(rank), key), place))
                size += len(rank)
                if size > 100_000:
                    yield _rows(out)
                    out, size = [], 0
            if out:
                yield _rows(out)

    def _rows(parts: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["rank", "key", "place"])

    return raw.mapInArrow(task, "rank bigint, key bigint, place bigint")


def _contexts(docs: DataFrame, text: str, shared: DataFrame) -> DataFrame:
    """(rank, crowd, key, first, around) of every shared anchor: the bytes of all its windows."""
    by_key = shared.groupBy("key").agg(F.collect_set(F.struct("place", "rank", "crowd")).alias("at"))
    texts = _packed(docs, text).groupBy("key").agg(F.first("packed").alias("packed"))
    both = by_key.join(texts, "key").select("key", "packed", F.col("at.place").alias("place"), F.col("at.rank").alias("rank"), F.col("at.crowd").alias("crowd"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        names = ["rank", "crowd", "key", "first", "around"]

        def rows(parts: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts, strict=True), kinds, strict=True)], names)

        for batch in batches:
            out = []
            for key, packed, places, marks, crowds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = unpress.decompress(packed)
                for place, rank, crowd in zip(places, marks, crowds, strict=True):
                    where, before, until = place >> 16, place >> 8 & 255, place & 255
                    out.append((rank, crowd, key, where - before, raw[where - before : where - until + LENGTH]))
                if len(out) > 20_000:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)

    return both.mapInArrow(task, "rank bigint, crowd boolean, key bigint, first bigint, around binary")


def _window_ranks(around: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank, row, offset) of every window of the given contexts."""
    sizes = np.fromiter((len(a) for a in around), np.int64, len(around))
    row = np.repeat(np.arange(len(around)), sizes)
    start = np.cumsum(sizes) - sizes
    rank = ranks(np.frombuffer(b"".join(around), np.uint8), LENGTH)
    whole = row[: len(rank)] == row[LENGTH - 1 :]
    return rank[whole], row[: len(rank)][whole], (np.arange(len(rank)) - start[row[: len(rank)]])[whole]


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[tuple]]:
    """Rows in chunks that end where the rank (first column) changes, if longer than ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size > limit and row[0] != held[-1][0]:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[-1])
    if held:
        yield held


def _quiet_repeats(contexts: DataFrame) -> DataFrame:
    """(key, first, last) removed bytes: windows that occur twice, for anchors without a crowd."""
    own = contexts.filter(~F.col("crowd")).select("rank", "key", "first", "around")
    placed = own.repartition("rank").sortWithinPartitions("rank")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, PIECE):
            mark = np.fromiter((r[0] for r in rows), np.int64, len(rows))
            key = np.fromiter((r[1] for r in rows), np.int64, len(rows))
            first = np.fromiter((r[2] for r in rows), np.int64, len(rows))
            rank, row, offset = _window_ranks([r[3] for r in rows])
            rank = _pair(rank, mark.view(np.uint64)[row])
            order = np.argsort(rank)
            same = rank[order][1:] == rank[order][:-1]
            again = np.zeros(len(rank), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            # a run of repeated windows of one row is one interval of bytes
            at = np.flatnonzero(again)
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (row[at][1:] != row[at][:-1])
            begin = at[new]
            stop = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
            yield pa.RecordBatch.from_pydict(
                {"key": key[row[begin]], "first": first[row[begin]] + offset[begin], "last": first[row[stop]] + offset[stop] + LENGTH}
            )

    return placed.mapInArrow(task, "key bigint, first bigint, last bigint")


def _crowd_repeats(contexts: DataFrame) -> DataFrame:
    """The same for anchors that a crowd shares.

    Equal contexts are one; a window is a repeat if its rank occurs in two
    contexts, or in one that occurs twice.
    """
    own = contexts.filter("crowd")
    kinds = own.groupBy("rank", "around").agg(F.count(F.lit(1)).alias("n"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, PIECE):
            rank, row, offset = _window_ranks([r[2] for r in rows])
            mark = np.fromiter((r[0] for r in rows), np.int64, len(rows))[row]
            n = np.fromiter((r[1] for r in rows), np.int64, len(rows))[row]
            yield pa.RecordBatch.from_pydict(
                {"rank": mark, "n": n, "kind": pa.array([rows[k][2] for k in row], pa.binary()), "at": offset, "window": rank.view(np.int64)}
            )

    windows = kinds.select("rank", "n", "around").mapInArrow(task, "rank bigint, n bigint, kind binary, at bigint, window bigint")
    windows = windows.withColumn("kind", F.xxhash64("rank", "kind"))
    counts = windows.groupBy("rank", "window").agg(F.sum("n").alias("all")).filter("all > 1")
    found = windows.join(counts, ["rank", "window"], "left_semi").groupBy("kind").agg(F.array_sort(F.collect_set("at")).alias("at"))
    hit = own.select("key", "first", F.xxhash64("rank", "around").alias("kind")).join(found, "kind")
    spans = hit.select("key", F.explode(F.transform("at", lambda a: F.struct((F.col("first") + a).alias("first"), (F.col("first") + a + LENGTH).alias("last")))).alias("s"))
    return spans.select("key", "s.first", "s.last")


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, spans) for texts with repeats: [first, last) byte ranges, unmerged."""
    rows = _anchor_rows(docs, text)
    place = F.struct("key", "place")
    met = rows.groupBy("rank").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.count(F.lit(1)).alias("n"))
    met = checkpointed(met.filter("least != most").select("rank", (F.col("n") > CROWD).alias("crowd")))
    shared = _anchor_rows(docs, text).join(met, "rank").select("key", "place", "rank", "crowd")
    contexts = _contexts(docs, text, shared)
    spans = _quiet_repeats(contexts)
    if not met.filter("crowd").isEmpty():
        spans = spans.unionByName(_crowd_repeats(contexts))
    return spans.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, copies, n_bytes, n_removed, n_spans, kept_sha256, kept) per distinct text of at least ``LENGTH`` bytes."""
    texts = _packed(docs, text).groupBy("key").agg(F.first("packed").alias("packed"), F.count(F.lit(1)).alias("copies"))
    both = texts.join(repeated_spans(docs, text), "key", "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for key, packed, copies, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = unpress.decompress(packed)
                merged: list[list[int]] = []
                for s in [{"first": 0, "last": len(raw)}] if copies > 1 else sorted(spans or (), key=lambda s: s["first"]):
                    if merged and s["first"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["last"])
                    else:
                        merged.append([s["first"], s["last"]])
                at, kept = 0, []
                for a, b in merged:
                    kept.append(raw[at:a])
                    at = b
                left = b"".join([*kept, raw[at:]])
                out.append((key, copies, len(raw), len(raw) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left))
            names = ["key", "copies", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = [pa.int64()] * 5 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "key bigint, copies bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return both.mapInArrow(task, schema)


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    raw = text_bytes("text")
    found = remove_repeats(docs).drop("kept", "copies", "n_bytes")
    own = docs.select("doc_id", F.octet_length(raw).cast("bigint").alias("n_bytes"), F.xxhash64(raw).alias("key"), F.sha2(raw, 256).alias("whole_sha256"))
    out = own.join(found, "key", "left")
    none = F.lit(0).cast("bigint")
    return out.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
