"""Whole texts in Arrow batches, and vectorised token hashing.

A task sees its documents in blocks of about ``BLOCK_BYTES``; a longer document
is a block of its own, and is hashed piece by piece, so memory follows the
longest document and not the size of a partition.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLOCK_BYTES = 1 << 18
#: Documents of a block at most.
BLOCK_DOCS = 1 << 12
#: Of an Arrow batch; it ends with the row that reaches this.
BATCH_BYTES = 1 << 21

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: In place of ``LOWER``, where case counts.
AS_IS = np.arange(256, dtype=np.uint8)

#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True

#: Bytes of ``[^\x20\x09-\x0D]``.
VISIBLE_BYTES = np.ones(256, bool)
VISIBLE_BYTES[9:14] = VISIBLE_BYTES[32] = False


def text_bytes(column: str) -> Column:
    """The text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def small_batches(spark: SparkSession) -> None:
    """From now on an Arrow batch takes about ``BATCH_BYTES``, unless the session has a limit of its own.

    A batch lies in memory whole, in Spark and in Python.  By Spark's own limit it
    would be a task's whole input, with as much again for what buffers grow by, and
    neither process gives that back.  Spark asks for the limit when rows are made,
    so it stays set.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(BATCH_BYTES))


def make_room(df: DataFrame, *added: str) -> DataFrame:
    """``df`` without the columns that results of the same names replace."""
    return df.select([df[c] for c in df.columns if c not in added])


class Shared:
    """A broadcast model whose class travels with it, so that tasks need no installed copy of the package."""

    def __init__(self, spark: SparkSession, model):
        self._data = spark.sparkContext.broadcast(cloudpickle.dumps(model))
        self._model = None

    @property
    def value(self):
        if self._model is None:
            self._model = pickle.loads(self._data.value)
        return self._model


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        base = np.full(max(n, 64), 0x9E3779B97F4A7C15, np.uint64)
        base[0] = 1
        _powers = np.cumprod(base, dtype=np.uint64)
    return _powers


def _hash_piece(raw: np.ndarray, kinds: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = fold[raw]
    inside = kinds[low]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    lens = ends - starts
    first = np.cumsum(lens) - lens
    offset = np.arange(lens.sum()) - np.repeat(first, lens)
    value = (low[inside].astype(np.uint64) + np.uint64(1)) * _powers_to(int(lens.max()))[offset]
    return mix(np.add.reduceat(value, first) + lens.astype(np.uint64)), starts, ends


def hash_tokens(
    data: bytes, kinds: np.ndarray, piece: int = 2 << 20, fold: np.ndarray = LOWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hashes, starts, ends) of the maximal runs of bytes in ``kinds``, A-Z lower-cased."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) <= piece:
        return _hash_piece(raw, kinds, fold)
    parts, at = [], 0
    outside = ~kinds[fold]
    while at < len(raw):
        to = min(len(raw), at + piece)
        while to < len(raw) and not outside[raw[to]]:
            to += 1
        h, s, e = _hash_piece(raw[at:to], kinds, fold)
        parts.append((h, s + at, e + at))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class Block:
    """Some documents: ``rows`` of the batch and their texts, joined by line ends."""

    def __init__(self, first: int, texts: list[bytes]):
        self.first, self.texts = first, texts
        self.data = b"\n".join(texts) + b"\n"
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def __len__(self) -> int:
        return len(self.texts)

    def tokens(self, kinds: np.ndarray, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, starts, ends, document) of all tokens, in order."""
        h, s, e = hash_tokens(self.data, kinds, fold=fold)
        return h, s, e, np.searchsorted(self.ends, s, side="right")


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and (size + len(text) > limit or len(held) == BLOCK_DOCS):
            yield Block(first, held)
            first, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield Block(first, held)


def map_blocks(
    df: DataFrame, text: str, make: Callable[[], Callable[[Block], dict]], schema: str, carry: list[str]
) -> DataFrame:
    """Per block, ``make()(block)`` gives the new columns, one value a document; ``carry`` columns pass through.

    ``make`` runs once a task, so it is the place to open broadcast models.
    ``text`` must be a binary column.
    """
    kept = df.select(*carry, text)
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c in carry)
    full = f"{types}, {schema}" if types else schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            whole = batch.column(batch.schema.names.index(text))
            for block in blocks(whole.to_pylist()):
                new = step(block)
                old = {c: batch.column(batch.schema.names.index(c)).slice(block.first, len(block)) for c in carry}
                yield pa.RecordBatch.from_pydict(old | {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in new.items()})

    return kept.mapInArrow(task, full)


def bounds(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def crc_share(column: str, parts: int) -> Column:
    """crc32 of the value as text, mod ``parts``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts
