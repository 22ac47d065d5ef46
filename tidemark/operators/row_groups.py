"""Products A A'Y of a matrix of sparse rows whose columns are too many for a table.

Rows go in groups, and each group is cut by blocks of columns once.  The dense vectors
of the rows of a group travel as one matrix; those of the columns, which are
far more, are made a block at a time inside a task and do not leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .sparse_rows import HELD_BYTES, matrix_of, packed_rows, reduced, sketch_of

# Rows of a group; numbers within a group have 16 bits.
GROUP_ROWS = 1_024
# Bytes of the entries that one task holds, and of one entry.
PIECE_BYTES = 128 << 20
ENTRY_BYTES = 14
# Bytes of vectors that are worked on at a time; they should stay in a core's cache.
CACHE_BYTES = 1 << 20


def block_count(rows: DataFrame, columns: int, width: int) -> int:
    """Blocks of columns such that a block's entries, and its vectors, fit a task; no fewer than cores."""
    entries = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    least = max(-(-columns * width * 8 // HELD_BYTES), -(-entries * ENTRY_BYTES // PIECE_BYTES), 1)
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return -(-least // tasks) * tasks


def cut_groups(rows: DataFrame, key: str, blocks: int, width: int) -> DataFrame:
    """(part, block, rows, columns, weights, keys, vector): a row for each group and block of columns.

    Column c is number c // ``blocks`` of block c % ``blocks``; entries are in order of
    columns.  Block -1 has the keys of the group, and its rows times ``width``
    columns of random signs.  Keep the result: groups are as rows come.
    """
    kind = dict(rows.dtypes)[key]
    schema = f"part bigint, block int, rows binary, columns binary, weights binary, keys array<{kind}>, vector binary"
    names = ["part", "block", "rows", "columns", "weights", "keys", "vector"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_ROWS):
                some = batch.slice(at, GROUP_ROWS)
                sizes = some.column(1).value_lengths().fill_null(0).to_numpy()
                column, value = some.column(1).flatten().to_numpy(), some.column(2).flatten().to_numpy()
                row = np.repeat(np.arange(len(sizes), dtype=np.int16), sizes)
                block = column % blocks
                order = np.lexsort((column, block))
                ends = np.searchsorted(block[order], np.arange(blocks + 1))
                parts = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                keys = pa.ListArray.from_arrays(pa.array([0] * (blocks + 1) + [some.num_rows], pa.int32()), some.column(0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * (blocks + 1)),
                        pa.array([*range(blocks), -1], pa.int32()),
                        pa.array([*(row[p].tobytes() for p in parts), None], pa.binary()),
                        pa.array([*((column[p] // blocks).astype(np.int32).tobytes() for p in parts), None], pa.binary()),
                        pa.array([*(value[p].astype(np.float64).tobytes() for p in parts), None], pa.binary()),
                        keys,
                        pa.array([*[None] * blocks, sketch_of(some.column(1), some.column(2), width).tobytes()], pa.binary()),
                    ],
                    names,
                )
                part += 1

    return rows.select(key, "terms", "weights").mapInArrow(task, schema)


def _added(out: np.ndarray, into: np.ndarray, source: np.ndarray, index: np.ndarray, value: np.ndarray) -> None:
    """Add ``value`` times the rows ``index`` of a source to the rows ``into``, which are in order."""
    step = max(1, CACHE_BYTES // (8 * max(1, out.shape[1])))
    for at in range(0, len(into), step):
        own = into[at : at + step]
        start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out[own[start]] += np.add.reduceat(source[index[at : at + step]] * value[at : at + step, None], start, axis=0)


def _by_block(cut: DataFrame, vectors: DataFrame, blocks: int) -> DataFrame:
    """Each block of columns in its own task: for group after group, the rows' vectors and then the entries."""
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    none = F.lit(None).cast("binary")
    entries = cut.filter("block >= 0").select("block", "part", F.lit(1).alias("kind"), "rows", "columns", "weights", none.alias("vector"))
    dense = vectors.select(every, "part", F.lit(0).alias("kind"), none.alias("rows"), none.alias("columns"), none.alias("weights"), "vector")
    return entries.unionByName(dense).repartitionById(blocks, "block").sortWithinPartitions("part", "kind")


def _column_vectors(batches: Iterator[pa.RecordBatch], size: int, width: int, held: list | None = None) -> tuple[int, np.ndarray, np.ndarray]:
    """(block, which columns have entries, A'Y of the block); with ``held``, the entries too."""
    total, seen, block, dense = np.zeros((size, width)), np.zeros(size, bool), 0, None
    for batch in batches:
        for i in range(batch.num_rows):
            if batch.column(2)[i].as_py() == 0:
                dense = np.frombuffer(batch.column(6)[i].as_buffer()).reshape(-1, width)
                continue
            block = batch.column(0)[i].as_py()
            row, column, weight = (np.frombuffer(batch.column(c)[i].as_buffer(), t).copy() for c, t in ((3, np.int16), (4, np.int32), (5, np.float64)))
            _added(total, column, dense, row, weight)
            seen[column] = True
            if held is not None:
                held.append((batch.column(1)[i].as_py(), len(dense), row, column, weight))
    return block, seen, total


def gram_of_groups(cut: DataFrame, vectors: DataFrame, blocks: int, columns: int, width: int) -> DataFrame:
    """(part, vector): for each group and block of columns, the block's part of A A'Y for the group's rows."""
    size = -(-columns // blocks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        _, _, total = _column_vectors(batches, size, width, held)
        for part, n, row, column, weight in held:
            order = np.argsort(row, kind="stable")
            out = np.zeros((n, width))
            _added(out, row[order], total, column[order], weight[order])
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([out.tobytes()], pa.binary())], ["part", "vector"])

    return _by_block(cut, vectors, blocks).mapInArrow(task, "part bigint, vector binary")


def columns_of_groups(cut: DataFrame, vectors: DataFrame, blocks: int, columns: int, width: int, table: np.ndarray) -> DataFrame:
    """(term_id, vector): A'Y times a small table, for columns that have entries."""
    size = -(-columns // blocks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen, total = _column_vectors(batches, size, width)
        own = np.flatnonzero(seen)
        for at in range(0, len(own), 4096):
            some = own[at : at + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(some * blocks + block), packed_rows(total[some] @ table)], ["term_id", "vector"])

    return _by_block(cut, vectors, blocks).mapInArrow(task, "term_id bigint, vector binary")


def columns_factor(cut: DataFrame, vectors: DataFrame, blocks: int, columns: int, width: int) -> np.ndarray:
    """R of the QR factorisation of A'Y; only the R of each block leaves its task."""
    size = -(-columns // blocks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([packed_rows(reduced([_column_vectors(batches, size, width)[2]]))], ["r"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [p for p in (matrix_of(batch.column(0)) for batch in batches) if p.size]
        if parts:
            yield pa.RecordBatch.from_arrays([packed_rows(reduced(parts))], ["r"])

    partial = _by_block(cut, vectors, blocks).mapInArrow(task, "r binary")
    tasks = cut.sparkSession.sparkContext.defaultParallelism
    found = matrix_of(partial.repartition(max(1, tasks // 4)).mapInArrow(join, "r binary").toArrow().column(0).combine_chunks())
    return reduced([found]) if found.size else np.zeros((0, width))


def _groups(batches: Iterator[pa.RecordBatch], widths: list[int]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(part, matrices): of each group, the matrix of each frame; those of one frame added up."""
    now, found = None, {}
    for batch in batches:
        for i in range(batch.num_rows):
            part, kind = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if part != now and found:
                yield now, [found[x] for x in sorted(found)]
                found = {}
            now, one = part, np.frombuffer(batch.column(2)[i].as_buffer()).reshape(-1, widths[kind])
            found[kind] = found[kind] + one if kind in found else one.copy()
    if found:
        yield now, [found[x] for x in sorted(found)]


def _together(frames: list[DataFrame]) -> DataFrame:
    """The groups' matrices of several frames, each group in one task."""
    made = None
    for i, frame in enumerate(frames):
        one = frame.filter("part IS NOT NULL").select("part", F.lit(i).alias("kind"), "vector")
        made = one if made is None else made.unionByName(one)
    return made.repartition("part").sortWithinPartitions("part", "kind")


def _group_row(part: int | None, matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary())], ["part", "vector"])


def with_products(basis: list[DataFrame], widths: list[int], partial: DataFrame, width: int) -> DataFrame:
    """(part, vector): partial matrices added up to W, and, without a part, the products [Q W]'W of each task's rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part, found in _groups(batches, [*widths, width]):
            product = np.concatenate(found, axis=1).T @ found[-1]
            total = product if total is None else total + product
            yield _group_row(part, found[-1])
        if total is not None:
            yield _group_row(None, total)

    return _together([*basis, partial]).mapInArrow(task, "part bigint, vector binary")


def products_of(frame: DataFrame, width: int) -> np.ndarray:
    """The sum of the rows without a part of ``with_products``."""
    found = frame.filter("part IS NULL").select("vector").toArrow().column("vector").to_pylist()
    return sum(np.frombuffer(x).reshape(-1, width) for x in found)


def residual(basis: list[DataFrame], widths: list[int], vectors: DataFrame, width: int, table: np.ndarray) -> DataFrame:
    """(part, vector): W - Q ``table``, and, without a part, the R of each task's rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = None
        for part, found in _groups(batches, [*widths, width]):
            left = found[-1] - np.concatenate(found[:-1], axis=1) @ table if widths else found[-1]
            factor = reduced([left] if factor is None else [factor, left])
            yield _group_row(part, left)
        if factor is not None:
            yield _group_row(None, factor)

    return _together([*basis, vectors]).mapInArrow(task, "part bigint, vector binary")


def factor_of(frame: DataFrame, width: int) -> np.ndarray:
    """The R of all rows of ``residual``."""
    found = frame.filter("part IS NULL").select("vector").toArrow().column("vector").to_pylist()
    return reduced([np.frombuffer(x).reshape(-1, width) for x in found]) if found else np.zeros((0, width))


def groups_turned(frames: list[DataFrame], widths: list[int], table: np.ndarray) -> DataFrame:
    """(part, vector): the matrices of some frames, side by side, times a small table."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _groups(batches, widths):
            yield _group_row(part, np.concatenate(found, axis=1) @ table)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield _group_row(part, np.frombuffer(packed.as_buffer()).reshape(-1, widths[0]) @ table)

    if len(frames) == 1:
        return frames[0].filter("part IS NOT NULL").select("part", "vector").mapInArrow(alone, "part bigint, vector binary")
    return _together(frames).mapInArrow(task, "part bigint, vector binary")


def rows_of_groups(cut: DataFrame, vectors: DataFrame, key: str, width: int) -> DataFrame:
    """(key, vector) of the groups' matrices, a row each."""
    kind = cut.schema["keys"].dataType.elementType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, packed in zip(batch.column(0), batch.column(1), strict=True):
                matrix = np.frombuffer(packed.as_buffer()).reshape(len(keys), width)
                yield pa.RecordBatch.from_arrays([keys.values, packed_rows(matrix)], [key, "vector"])

    members = cut.filter("block = -1").select("part", "keys")
    return members.join(vectors, "part").select("keys", "vector").mapInArrow(task, f"{key} {kind}, vector binary")
