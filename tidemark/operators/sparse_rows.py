"""Products and factors of a matrix that is a frame of sparse rows, with numpy inside tasks.

A matrix row is (key, terms, weights): column numbers and values.  Dense vectors
travel as binary columns of doubles.  Nothing here has all rows, or all columns
times all columns, in one place: sums are made per task and then per key, and the
R of a QR factorisation, as wide as the dense vectors, by a tree of partial ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.vectors import sparse_parts

# Cells of a dense block of rows by their columns.
BLOCK_CELLS = 1 << 20
# Bytes of sums that a task holds before it sends them on.
HELD_BYTES = 64 << 20
# Bytes of the dense vectors of one block of columns.
COLUMN_BLOCK_BYTES = 16 << 20
# Bytes of cells that a task makes at a time.
CELL_BYTES = 8 << 20

# Bytes of an Arrow batch of dense vectors.
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on an Arrow batch takes about ``BATCH_BYTES``, unless the session has a limit of its own."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(BATCH_BYTES))


def matrix_rows(vectors: DataFrame, key: str, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """(key, terms, weights, ...keep) of a Spark ML vector column."""
    terms, weights = sparse_parts(F.col(column))
    return vectors.select(key, terms.cast("array<bigint>").alias("terms"), weights.alias("weights"), *keep)


def as_doubles(column: str) -> Column:
    """The array of a binary column of doubles."""

    @F.pandas_udf("array<double>")
    def unpack(packed):
        return packed.map(lambda b: np.frombuffer(b, np.float64))

    return unpack(column)


def as_packed(column: str) -> Column:
    """A binary column of doubles, of an array."""

    @F.pandas_udf("binary")
    def pack(values):
        return values.map(lambda v: np.asarray(v, np.float64).tobytes())

    return pack(F.col(column).cast("array<double>"))


def matrix_of(packed: pa.Array) -> np.ndarray:
    """The dense vectors of a binary column, a row each; not copied."""
    if not len(packed):
        return np.zeros((0, 0))
    if packed.type != pa.binary():
        packed = packed.cast(pa.binary())
    _, ends, data = packed.buffers()
    ends = np.frombuffer(ends, np.int32, len(packed) + 1, 4 * packed.offset)
    if ends[0] == ends[-1]:
        return np.zeros((len(packed), 0))
    return np.frombuffer(data, np.float64, (int(ends[-1]) - int(ends[0])) // 8, int(ends[0])).reshape(len(packed), -1)


def packed_rows(matrix: np.ndarray) -> pa.Array:
    width = 8 * matrix.shape[1]
    ends = (np.arange(len(matrix) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def dense_blocks(terms: pa.Array, weights: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, stop, columns, block): rows start to stop, dense over the columns that they have."""
    sizes = terms.value_lengths().fill_null(0).to_numpy()
    column, value = terms.flatten().to_numpy(), weights.flatten().to_numpy()
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        cells = np.arange(1, len(sizes) - start + 1) * (ends[start:] - ends[start] + sizes[start])
        stop = start + max(1, int(np.searchsorted(cells, BLOCK_CELLS)))
        some = slice(ends[start] - sizes[start], ends[stop - 1])
        own, place = np.unique(column[some], return_inverse=True)
        block = np.zeros((stop - start, len(own)))
        np.add.at(block, (np.repeat(np.arange(stop - start), sizes[start:stop]), place), value[some])
        yield start, stop, own, block
        start = stop


class Sums:
    """Sums of dense vectors by number, emptied when they hold more than ``HELD_BYTES``."""

    def __init__(self, width: int):
        self.width, self.numbers, self.parts, self.size = width, [], [], 0

    def add(self, numbers: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.numbers.append(numbers)
        self.parts.append(vectors)
        self.size += vectors.nbytes
        if self.size > HELD_BYTES:
            self._shrink()
            if self.size > HELD_BYTES // 2:
                yield from self.empty()

    def _shrink(self) -> None:
        number, place = np.unique(np.concatenate(self.numbers), return_inverse=True)
        total = np.zeros((len(number), self.width))
        at = 0
        for part in self.parts:  # each part's numbers are distinct
            total[place[at : at + len(part)]] += part
            at += len(part)
        self.numbers, self.parts, self.size = [number], [total], total.nbytes

    def empty(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._shrink()
            rows = max(1, (8 << 20) // max(8, 8 * self.width))
            for at in range(0, len(self.numbers[0]), rows):
                part = slice(at, at + rows)
                yield pa.RecordBatch.from_arrays([pa.array(self.numbers[0][part]), packed_rows(self.parts[0][part])], ["term_id", "vector"])
        self.numbers, self.parts, self.size = [], [], 0


def summed(partial: DataFrame, key: str) -> DataFrame:
    """(key, vector): the partial vectors of each key added up, a row at a time."""
    kind = dict(partial.dtypes)[key]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, started, key_type = None, None, False, None
        keys, totals = [], []
        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vector = np.frombuffer(packed, np.float64)
                if started and k == now:
                    total = total + vector
                    continue
                if started:
                    keys.append(now)
                    totals.append(total.tobytes())
                now, total, started = k, vector, True
                if len(keys) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array(totals, pa.binary())], [key, "vector"])
                    keys, totals = [], []
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([*keys, now], key_type), pa.array([*totals, total.tobytes()], pa.binary())], [key, "vector"])

    placed = partial.select(key, "vector").repartition(key).sortWithinPartitions(key)
    return placed.mapInArrow(add, f"{key} {kind}, vector binary")


def _r_of_parts(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """R of the rows of all parts, of which a task holds few."""
    held, size = [], 0
    for part in parts:
        if len(part):
            held.append(part)
            size += len(part)
            if size > 2 * part.shape[1] + 4096:
                held = [reduced(held)]
                size = len(held[0])
    if held:
        yield pa.RecordBatch.from_arrays([packed_rows(reduced(held))], ["r"])


def few_tasks(rows: DataFrame, known: bool = False) -> DataFrame:
    """The rows in at most four tasks a core, for what sends much from each task whatever its rows.

    Rows that are in no more tasks stay as they are and in their order; how many there are is
    asked only of rows that are ``known``, as those of a checkpoint, since it may run their plan.
    """
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    return rows if known and rows.rdd.getNumPartitions() <= tasks else rows.coalesce(tasks)


def reduced(held: list[np.ndarray]) -> np.ndarray:
    """R of the rows of all parts, or the rows themselves if these are fewer."""
    whole = np.concatenate(held)
    return np.linalg.qr(whole, mode="r") if len(whole) > whole.shape[1] else whole


def _products(batch: pa.RecordBatch, terms: int, weights: int, table: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, stop, product): the rows of a batch times a table, a block at a time."""
    for start, stop, own, block in dense_blocks(batch.column(terms), batch.column(weights)):
        yield start, stop, block @ table[own]


def r_factor(rows: DataFrame, column: str = "vector", table: np.ndarray | None = None) -> np.ndarray:
    """R of the QR factorisation of a tall matrix of dense rows; as many columns squared, on the driver.

    With a ``table``, of a checked size, the matrix is that of ``times_table``, which is made a
    block at a time and never leaves its task.
    """
    shared = None if table is None else rows.sparkSession.sparkContext.broadcast(table)

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _r_of_parts(matrix_of(batch.column(0)) for batch in batches)

    def product_factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _r_of_parts(product for batch in batches for _, _, product in _products(batch, 0, 1, shared.value))

    partial = rows.select(column).mapInArrow(factor, "r binary") if table is None else few_tasks(rows.select("terms", "weights"), True).mapInArrow(product_factor, "r binary")
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    partial = partial.repartition(max(1, tasks // 4)).mapInArrow(factor, "r binary")
    found = matrix_of(partial.toArrow().column(0).combine_chunks())
    return reduced([found]) if len(found) else found


def times_table(rows: DataFrame, key: str, table: np.ndarray, keep: Sequence[str] = ()) -> DataFrame:
    """(key, terms, weights, ...keep, vector): each row times a table of all columns, which goes to the tasks.

    For tables of a checked size.
    """
    shared = rows.sparkSession.sparkContext.broadcast(table)
    names = [key, "terms", "weights", *keep]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, product in _products(batch, 1, 2, shared.value):
                own = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*own.columns, packed_rows(product)], [*names, "vector"])

    kinds = dict(rows.dtypes) | {"terms": "array<bigint>", "weights": "array<double>"}
    return rows.select(*names).mapInArrow(task, ", ".join(f"{c} {kinds[c]}" for c in names) + ", vector binary")


def gram_times(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """(term_id, vector): A'A times a table of all columns, of a checked size.

    The rows' products with the table are used a block at a time and never leave their task.
    """
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(shared.value.shape[1])
        for batch in batches:
            for _, _, own, block in dense_blocks(batch.column(0), batch.column(1)):
                if len(own):
                    yield from sums.add(own, block.T @ (block @ shared.value[own]))
        yield from sums.empty()

    return summed(few_tasks(rows.select("terms", "weights"), True).mapInArrow(task, "term_id bigint, vector binary"), "term_id")


def _salts(rows: DataFrame, blocks: int) -> int:
    """Tasks that share the rows of one block of columns: one, unless blocks are fewer than cores."""
    return max(1, -(-rows.sparkSession.sparkContext.defaultParallelism // blocks))


def times_frame(rows: DataFrame, key: str, vectors: DataFrame, width: int, count: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The same for ``count`` vectors (term_id, vector), any number: a join by blocks of columns.

    Rows are cut by block; a block's vectors come first in their task and its
    pieces of rows follow, so a task holds one block.  The partial sums then
    meet at their rows.
    """
    blocks = F.pmod(F.xxhash64("term_id"), F.lit(1 << 40))
    count = vectors.count() if count is None else count
    number = max(1, -(-count * width * 8 // COLUMN_BLOCK_BYTES))
    salts = _salts(rows, number)
    kind = dict(rows.dtypes)[key]
    entries = rows.select(key, F.arrays_zip("terms", "weights").alias("_e")).select(key, F.explode("_e").alias("_e"))
    entries = entries.select(key, F.col("_e.terms").alias("term_id"), F.col("_e.weights").alias("weight"))
    entries = entries.withColumn("block", (blocks % number).cast("int")).withColumn("salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    entries = entries.select("block", "salt", F.lit(1).alias("kind"), key, "term_id", "weight", F.lit(None).cast("binary").alias("vector"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    tables = vectors.select((blocks % number).cast("int").alias("block"), every.alias("salt"), "term_id", "vector")
    tables = tables.select("block", "salt", F.lit(0).alias("kind"), F.lit(None).cast(kind).alias(key), "term_id", F.lit(0.0).alias("weight"), "vector")
    placed = entries.unionByName(tables).repartition("block", "salt").sortWithinPartitions("block", "salt", "kind", key, "term_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, numbers, table, columns = None, [], [], None, None
        for batch in batches:
            where = batch.column(0).to_numpy() * salts + batch.column(1).to_numpy()
            cut = np.flatnonzero(np.diff(where * 2 + batch.column(2).to_numpy())) + 1
            for a, b in zip([0, *cut], [*cut, len(where)], strict=True):
                part = batch.slice(a, b - a)
                if part.column(2)[0].as_py() == 0:
                    if where[a] != place:
                        place, parts, numbers, table = where[a], [], [], None
                    parts.append(matrix_of(part.column(6)))
                    numbers.append(part.column(4).to_numpy())
                    continue
                if where[a] != place:  # a block of columns without vectors
                    continue
                if table is None:
                    table, columns = np.concatenate(parts), np.concatenate(numbers)
                    order = np.argsort(columns)
                    table, columns = table[order], columns[order]
                term, weight, keys = part.column(4).to_numpy(), part.column(5).to_numpy(), part.column(3)
                at = np.minimum(np.searchsorted(columns, term), len(columns) - 1)
                weight = np.where(columns[at] == term, weight, 0.0)
                code = keys.dictionary_encode()
                index = code.indices.to_numpy()
                for low in range(0, len(code.dictionary), 256):
                    some = np.flatnonzero((index >= low) & (index < low + 256))
                    size = min(256, len(code.dictionary) - low)
                    own, back = np.unique(at[some], return_inverse=True)
                    block = np.zeros((size, len(own)))
                    np.add.at(block, (index[some] - low, back), weight[some])
                    yield pa.RecordBatch.from_arrays([code.dictionary.slice(low, size), packed_rows(block @ table[own])], [key, "vector"])

    none = F.lit(np.zeros(width).tobytes())  # rows without a column have a vector too
    partial = placed.mapInArrow(task, f"{key} {kind}, vector binary").unionByName(rows.select(key, none.alias("vector")))
    return rows.select(key, "terms", "weights", *keep).join(summed(partial, key), key)


def transposed_times(rows: DataFrame) -> DataFrame:
    """(term_id, vector): the sum over rows (terms, weights, vector) of each column's weight times the row's vector."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            right = matrix_of(batch.column(2))
            sums = sums or Sums(right.shape[1])
            for start, stop, own, block in dense_blocks(batch.column(0), batch.column(1)):
                if len(own):
                    yield from sums.add(own, block.T @ right[start:stop])
        if sums:
            yield from sums.empty()

    return summed(few_tasks(rows.select("terms", "weights", "vector")).mapInArrow(task, "term_id bigint, vector binary"), "term_id")


def turned(rows: DataFrame, column: str, table: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` and vector: each dense vector times a small table."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    kinds = dict(rows.dtypes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = matrix_of(batch.column(len(keep))) @ shared.value
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], packed_rows(out)], [*keep, "vector"])

    return rows.select(*keep, column).mapInArrow(task, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", vector binary")


def sketch_of(terms: pa.Array, weights: pa.Array, width: int, per_column: int = 8) -> np.ndarray:
    """The rows times a sparse table of random signs, made from the column numbers."""
    out = np.zeros((len(terms), width))
    for start, stop, own, block in dense_blocks(terms, weights):
        table = np.zeros((len(own), width))
        for k in range(per_column):
            bits = (own.astype(np.uint64) + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
            bits = (bits ^ (bits >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
            bits ^= bits >> np.uint64(29)
            np.add.at(table, (np.arange(len(own)), (bits >> np.uint64(1)) % np.uint64(width)), np.where(bits & np.uint64(1), 1.0, -1.0))
        out[start:stop] = block @ table
    return out


def column_squares(rows: DataFrame, left: str, right: str, scale: np.ndarray, times: str | None = None) -> DataFrame:
    """(concept, length, gap): sums over rows, each taken ``times`` times, of y^2 and of (x - scale y)^2 for each place of two vectors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(scale)))
        for batch in batches:
            step = max(1, BLOCK_CELLS // max(1, len(scale)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x, y = matrix_of(part.column(0)), matrix_of(part.column(1))
                count = part.column(2).to_numpy()
                total += count @ (y * y), count @ np.square(x - scale * y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(scale), dtype=np.int32)), pa.array(total[0]), pa.array(total[1])], ["concept", "length", "gap"])

    each = F.lit(1.0) if times is None else F.col(times).cast("double")
    sums = rows.select(left, right, each.alias("_times")).mapInArrow(task, "concept int, length double, gap double")
    return sums.groupBy("concept").agg(F.sum("length").alias("length"), F.sum("gap").alias("gap"))


def _cells_of(keys: pa.Array, left: np.ndarray, numbers: np.ndarray, right: np.ndarray, key: str) -> Iterator[pa.RecordBatch]:
    """(key, term_id, value) of left times right', about ``CELL_BYTES`` of values at a time."""
    if not len(numbers) or not right.shape[1]:
        return
    step = max(1, CELL_BYTES // (8 * len(numbers)))
    for low in range(0, len(left), step):
        values = left[low : low + step] @ right.T
        own = pa.array(np.repeat(np.arange(low, low + len(values)), len(numbers)))
        yield pa.RecordBatch.from_arrays([keys.take(own), pa.array(np.tile(numbers, len(values))), pa.array(values.ravel())], [key, "term_id", "value"])


def cells(rows: DataFrame, key: str, vectors: DataFrame, width: int, table: bool) -> DataFrame:
    """(key, term_id, value): the product of each row's vector (key, vector) with that of each column (term_id, vector).

    As a ``table``, of a checked size, the columns' vectors go to the tasks.  Else rows meet
    blocks of them: a block comes first in its task and rows follow, so a task holds one block.
    """
    kind = dict(rows.dtypes)[key]
    schema = f"{key} {kind}, term_id bigint, value double"
    if table:
        found = vectors.select("term_id", "vector").toArrow()
        numbers = found.column("term_id").to_numpy()
        shared = rows.sparkSession.sparkContext.broadcast((numbers, matrix_of(found.column("vector").combine_chunks()).copy()))

        def by_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield from _cells_of(batch.column(0), matrix_of(batch.column(1)), *shared.value, key)

        return rows.select(key, "vector").mapInArrow(by_table, schema)

    number = max(1, -(-vectors.count() * width * 8 // COLUMN_BLOCK_BYTES))
    salts = max(_salts(rows, number), rows.count() * width * 8 // HELD_BYTES)
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    own_block = F.pmod(F.xxhash64("term_id"), F.lit(number)).cast("int")
    right = vectors.select(own_block.alias("block"), every.alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast(kind).alias(key), "term_id", "vector")
    salt = F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("salt")
    left = rows.select(F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("block"), salt, F.lit(1).alias("kind"), key, F.lit(None).cast("bigint").alias("term_id"), "vector")
    placed = left.unionByName(right).repartition("block", "salt").sortWithinPartitions("block", "salt", "kind")

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, numbers, parts = None, [], []
        for batch in batches:
            where = batch.column(0).to_numpy().astype(np.int64) * salts + batch.column(1).to_numpy()
            cut = np.flatnonzero(np.diff(where * 2 + batch.column(2).to_numpy())) + 1
            for a, b in zip([0, *cut], [*cut, len(where)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if where[a] != place:
                    place, numbers, parts = where[a], [], []
                if part.column(2)[0].as_py() == 0:
                    numbers.append(part.column(4).to_numpy())
                    parts.append(matrix_of(part.column(5)).copy())
                elif parts:
                    if len(parts) > 1:
                        numbers, parts = [np.concatenate(numbers)], [np.concatenate(parts)]
                    yield from _cells_of(part.column(3), matrix_of(part.column(5)), numbers[0], parts[0], key)

    return placed.mapInArrow(by_block, schema)
