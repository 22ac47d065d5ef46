"""Language-model scores by Brown classes.

The log-probability of a word is that of its class after the previous word's
class, plus that of the word in its class.  Exchange clustering assigns the
``CLUSTERED`` most frequent words to ``CLASSES`` classes.  Every other word of at
least ``LEAST`` occurrences then moves to the class where it gains most, by the
classes that precede and follow it: Spark adds up these counts, and tasks judge
words against the class table, which no longer changes.  Words of fewer
occurrences, and unseen ones, belong to a class by their shape (length, last
byte, other alphabets); the end of a text is a class of its own.  All counts are
over all training texts, and the classes' transitions are counted anew at last.

Tokens are runs of ``blocks.VISIBLE_BYTES`` with A-Z lower-cased, then one end.

Defined cases: a null text is empty and has one token, its end; repeated rows
count and are scored each; a long text is a block of its own, and its rare words
are rows of their own; of classes that gain a word equally the first takes it,
of words that are equally frequent the one of least hash counts as more frequent;
with no training rows every known count is 0 and the scores are those of the
smoothing alone; no documents give no rows; a column with the name of a result is
replaced by it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.blocks import VISIBLE_BYTES, Block, Shared, blocks, bounds, crc_share, make_room, map_blocks, text_bytes
from tidemark.sources.scratch import checkpointed

CLUSTERED = 1000
CLASSES = 64
#: Words of fewer occurrences stay in the class of their shape.
LEAST = 3
#: Words whose counts and classes every task holds; those of rarer words are joined.
FREQUENT = 1 << 18
ROUNDS = 6
#: Counts of a pair of classes are smoothed by this many draws from the second's share.
PRIOR = 20.0
SHAPES = 24
#: Distinct words whose neighbours a task adds up at a time, about.
BUCKET_WORDS = 100_000


def shapes(block: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    data = np.frombuffer(block.data, np.uint8)
    first, last = data[starts], data[ends - 1]
    size = np.searchsorted([2, 4, 6, 8, 11], ends - starts)
    letter = (last >= 128) | ((last | 32) >= 97) & ((last | 32) <= 122)
    return size * 4 + letter * 2 + (first >= 128)


def _added(hashes: np.ndarray, shape: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    hashes, shape, n = hashes[order], shape[order], n[order]
    first = bounds(hashes)
    return hashes[first], shape[first], np.add.reduceat(n, first) if len(first) else n


def count_tokens(docs: DataFrame, text: str, most: int = 2_000_000) -> DataFrame:
    """(word, shape, n) over whole texts, without ends; a task holds ``most`` words, and adds up before the shuffle."""
    rows = docs.select(text_bytes(text).alias("raw"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def emit(part: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": part[0].view(np.int64), "shape": part[1].astype(np.int8), "n": part[2]})

        for batch in batches:
            for block in blocks(batch.column(0).to_pylist()):
                h, s, e, _ = block.tokens(VISIBLE_BYTES)
                held.append(_added(h, shapes(block, s, e), np.ones(len(h), np.int64)))
                size += len(held[-1][0])
                if size > 2 * most:
                    held = [_added(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > most:
                        yield emit(held[0])
                        held, size = [], 0
        if held:
            yield emit(_added(*(np.concatenate(x) for x in zip(*held, strict=True))))

    partial = rows.mapInArrow(task, "word bigint, shape tinyint, n bigint")
    return partial.groupBy("word").agg(F.first("shape").alias("shape"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Some words (sorted) with counts and symbols; other words have a symbol by shape, and the end the last one."""

    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    base: int  # the first symbol of a shape

    @property
    def size(self) -> int:
        return self.base + SHAPES + 1

    def look_up(self, hashes: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, count; -1 if the word is not here)."""
        if not len(self.words):
            return self.base + shape, np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        return np.where(known, self.symbols[at], self.base + shape), np.where(known, self.counts[at], -1)


def sequence(block: Block, vocabulary: Vocabulary):
    """Symbols with an end before the block and after each document, and the block's tokens.

    Token k is at ``k + doc[k] + 1`` of the chain.
    """
    h, s, e, doc = block.tokens(VISIBLE_BYTES)
    shape = shapes(block, s, e)
    symbol, count = vocabulary.look_up(h, shape)
    chain = np.full(len(h) + len(block) + 1, vocabulary.size - 1)
    chain[np.arange(len(h)) + doc + 1] = symbol
    return chain, h, shape, symbol, count, doc


def count_pairs(docs: DataFrame, text: str, vocabulary: Vocabulary) -> np.ndarray:
    """How often one symbol follows another; the matrix is bounded by the clustered vocabulary."""
    spark = docs.sparkSession
    shared = Shared(spark, vocabulary)
    size = vocabulary.size

    def rows_of(total: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(total.any(axis=1))
        return pa.RecordBatch.from_pydict(
            {"a": some.astype(np.int32), "row": pa.array([zlib.compress(total[k].tobytes(), 1) for k in some], pa.binary())}
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0).to_pylist()):
                chain = sequence(block, shared.value)[0]
                pair, n = np.unique(chain[:-1] * size + chain[1:], return_counts=True)
                total[pair] += n
        yield rows_of(total.reshape(size, size))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), np.int64)
        for batch in batches:
            for a, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[a] += np.frombuffer(zlib.decompress(row), np.int64)
        yield rows_of(total)

    partial = docs.select(text_bytes(text).alias("raw")).mapInArrow(task, "a int, row binary")
    found = partial.repartition("a").mapInArrow(add, "a int, row binary").toArrow()
    out = np.zeros((size, size), np.int64)
    for a, row in zip(found.column("a").to_pylist(), found.column("row").to_pylist(), strict=True):
        out[a] += np.frombuffer(zlib.decompress(row), np.int64)
    return out


def exchange(pairs: np.ndarray, words: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of each symbol: words move one by one to the class with the most likely pairs; other symbols stay alone."""
    others = len(pairs) - words
    classes = min(classes, max(words, 1))
    size = classes + others
    of = np.concatenate([np.arange(words) % classes, classes + np.arange(others)])

    joint = np.zeros((size, size))
    np.add.at(joint, (of[:, None], of[None, :]), pairs)
    for _ in range(rounds):
        moved = 0
        for w in range(words):
            row = np.bincount(of, pairs[w], size)
            column = np.bincount(of, pairs[:, w], size)
            itself, old = pairs[w, w], of[w]
            row[old] -= itself
            column[old] -= itself
            joint[old] -= row
            joint[:, old] -= column
            joint[old, old] -= itself
            left, right = joint.sum(axis=1)[:classes], joint.sum(axis=0)[:classes]
            top, side = joint[:classes], joint[:, :classes].T
            gain = (g(top + row) - g(top)).sum(axis=1) + (g(side + column) - g(side)).sum(axis=1)
            k = np.arange(classes)
            own = joint[k, k]
            gain -= g(own + row[k]) + g(own + column[k]) - g(own)
            gain += g(own + row[k] + column[k] + itself)
            gain -= g(left + row.sum() + itself) - g(left) + g(right + column.sum() + itself) - g(right) + g(own)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            moved += new != old
            of[w] = new
            joint[new] += row
            joint[:, new] += column
            joint[new, new] += itself
        if not moved:
            break
    return of


def g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gains(joint: np.ndarray, classes: int, word: np.ndarray, side: np.ndarray, n: np.ndarray, words: int) -> np.ndarray:
    """words x classes: what the likelihood of the class pairs gains if the word joins the class.

    Row k says that ``word[k]`` (0 to ``words``, ascending) was ``n[k]`` times after
    class ``side[k]``, or before class ``side[k] - len(joint)``.
    """
    size = len(joint)
    after, k = side < size, side % size
    out = np.zeros((words, classes))
    first = bounds(word)
    own = np.zeros((2, words, classes))
    for flag in (0, 1):
        some = (after == bool(flag)) & (k < classes)
        own[flag][word[some], k[some]] = n[some]
    cell = np.where(after[:, None], joint[:, :classes][k], joint[:classes].T[k])
    out[word[first]] = np.add.reduceat(g(cell + n[:, None]) - g(cell), first, axis=0) if len(first) else 0
    both = joint[np.arange(classes), np.arange(classes)]
    out += g(both + own[0] + own[1]) - g(both + own[0]) - g(both + own[1]) + g(both)
    for flag, whole in ((0, joint.sum(axis=1)), (1, joint.sum(axis=0))):
        # a word before its neighbours adds to its class as a first one, and the other way round
        times = np.bincount(word, n * (after == bool(flag)), words)[:, None]
        out -= g(whole[:classes] + times) - g(whole[:classes])
    return out


def _merged(parts: list[tuple]) -> tuple:
    """(word, shape, side, n) with equal words and sides added up, in their order."""
    word, shape, side, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((side, word))
    word, shape, side, n = word[order], shape[order], side[order], n[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (side[1:] != side[:-1])
    first = np.flatnonzero(new)
    return word[first], shape[first], side[first], np.add.reduceat(n, first) if len(first) else n


def assign(docs: DataFrame, text: str, near: Vocabulary, joint: np.ndarray, least: int, distinct: int, most: int = 1_000_000) -> DataFrame:
    """(word, n, class) of all words that are not in ``near``, whose symbols are classes.

    Tasks send each word's neighbouring classes and their counts, compressed and by
    buckets of words; a bucket is added up piece by piece in one task.
    """
    buckets = distinct // BUCKET_WORDS + 32
    size, classes = near.size, near.base
    shared = Shared(docs.sparkSession, (near, joint))
    side_type = np.uint8 if size <= 128 else np.int32

    def packed(part: tuple) -> Iterator[pa.RecordBatch]:
        bucket = part[0] % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        part, bucket = [x[order] for x in part], bucket[order]
        first = bounds(bucket)
        blobs = []
        for a, b in zip(first, np.append(first[1:], len(bucket)), strict=True):
            word = bounds(part[0][a:b]) + a
            sizes = np.diff(np.append(word, b)).astype(np.int32)
            columns = (part[0][word], part[1][word].astype(np.int8), sizes, part[2][a:b].astype(side_type), part[3][a:b])
            blobs.append(len(word).to_bytes(8, "little") + zlib.compress(b"".join(c.tobytes() for c in columns), 1))
        yield pa.RecordBatch.from_pydict({"bucket": bucket[first].astype(np.int64), "part": pa.array(blobs, pa.binary())})

    def opened(blob: bytes) -> tuple:
        words, data = int.from_bytes(blob[:8], "little"), zlib.decompress(blob[8:])
        word, shape = np.frombuffer(data, np.uint64, words), np.frombuffer(data, np.int8, words, 8 * words)
        sizes = np.frombuffer(data, np.int32, words, 9 * words)
        pairs = int(sizes.sum())
        side = np.frombuffer(data, side_type, pairs, 13 * words)
        n = np.frombuffer(data, np.int64, pairs, 13 * words + side.nbytes)
        return np.repeat(word, sizes), np.repeat(shape, sizes), side.astype(np.int64), n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = shared.value[0]
        held: list[tuple] = []
        waiting = 0
        for batch in batches:
            for block in blocks(batch.column(0).to_pylist()):
                chain, h, shape, _, n, doc = sequence(block, near)
                other = np.flatnonzero(n < 0)
                at = other + doc[other] + 1
                before = (h[other], shape[other], chain[at - 1], np.ones(len(other), np.int64))
                behind = (h[other], shape[other], chain[at + 1] + size, np.ones(len(other), np.int64))
                if not len(other):
                    continue
                held.append(_merged([before, behind]))
                waiting += len(held[-1][0])
                if waiting > 2 * most:
                    held = [_merged(held)]
                    waiting = len(held[0][0])
                    if waiting > most:
                        yield from packed(held[0])
                        held, waiting = [], 0
        if held:
            yield from packed(_merged(held))

    def judged(part: tuple) -> Iterator[pa.RecordBatch]:
        joint = shared.value[1]
        word, shape, side, n = part
        first = bounds(word)
        ends = np.append(first[1:], len(word))
        for a in range(0, len(first), 4096):
            start, stop = first[a : a + 4096], ends[a : a + 4096]
            rows = slice(start[0], stop[-1])
            index = np.repeat(np.arange(len(start)), stop - start)
            times = np.bincount(index, n[rows] * (side[rows] < size), len(start)).astype(np.int64)
            kind = classes + shape[start].astype(np.int64)
            enough = times >= least
            if enough.any():
                some = enough[index]
                dense = (np.cumsum(enough) - 1)[index[some]]
                kind[enough] = gains(joint, classes, dense, side[rows][some], n[rows][some], int(enough.sum())).argmax(axis=1)
            yield pa.RecordBatch.from_pydict({"word": word[start].view(np.int64), "n": times, "class": kind.astype(np.int32)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting = None, [], 0
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now and held:
                    yield from judged(_merged(held))
                    held, waiting = [], 0
                now = bucket
                held.append(opened(blob))
                waiting += len(held[-1][0])
                if waiting > 2 * most + 2 * len(held[0][0]):
                    held = [_merged(held)]
                    waiting = len(held[0][0])
        if held:
            yield from judged(_merged(held))

    partial = docs.select(text_bytes(text).alias("raw")).mapInArrow(count, "bucket bigint, part binary")
    dealt = partial.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(add, "word bigint, n bigint, class int")


@dataclass
class Model:
    vocabulary: Vocabulary  # the most frequent words; symbols are classes
    moves: np.ndarray  # class x class, log10
    mass: np.ndarray  # per class, log10 of the occurrences in it, each word of a shape counted once more, and an unseen one
    tokens: int
    distinct: int
    end: int


def _met(rare: DataFrame, lexicon: DataFrame, base: int) -> DataFrame:
    """Rare words with their counts and classes, and the classes before and behind; a null class behind is the next row's."""
    met = rare.join(lexicon, "word", "left").select(
        "row",
        "place",
        "before",
        "behind",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("class", F.col("shape") + base).alias("class"),
    )
    last = F.lag("class").over(Window.partitionBy("row").orderBy("place"))
    return met.withColumn("before", F.coalesce("before", last))


def _rare_words(chain: np.ndarray, h: np.ndarray, shape: np.ndarray, count: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, dict]:
    """Which tokens are not in the vocabulary, and their columns; a class beside them is null where that word is rare too."""
    hole = np.zeros(len(chain), bool)
    rare = np.flatnonzero(count < 0)
    at = rare + doc[rare] + 1
    hole[at] = True
    columns = {
        "place": pa.array(at, pa.int64()),
        "word": pa.array(h[rare].view(np.int64)),
        "shape": pa.array(shape[rare].astype(np.int32)),
        "before": pa.array(chain[at - 1].astype(np.int32), mask=hole[at - 1]),
        "behind": pa.array(chain[at + 1].astype(np.int32), mask=hole[at + 1]),
    }
    return hole, columns


def count_moves(docs: DataFrame, text: str, vocabulary: Vocabulary, lexicon: DataFrame) -> np.ndarray:
    """How often one class follows another: pairs of frequent words are added up in tasks, those of rare words meet their classes first."""
    shared = Shared(docs.sparkSession, vocabulary)
    size = vocabulary.size
    rows = docs.select(text_bytes(text).alias("raw"), F.monotonically_increasing_id().alias("row"))
    schema = "row bigint, place bigint, word bigint, shape int, before int, behind int, n bigint"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            ids = batch.column(1).to_numpy()
            for block in blocks(batch.column(0).to_pylist()):
                chain, h, shape, _, count, doc = sequence(block, shared.value)
                hole, rare = _rare_words(chain, h, shape, count, doc)
                whole = ~hole[:-1] & ~hole[1:]
                pair, n = np.unique(chain[:-1][whole] * size + chain[1:][whole], return_counts=True)
                total[pair] += n
                of = ids[block.first + doc[count < 0]]
                yield pa.RecordBatch.from_pydict({"row": of, **rare, "n": np.ones(len(of), np.int64)})
        some = np.flatnonzero(total)
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_pydict(
            {
                "row": none,
                "place": none,
                "word": none,
                "shape": pa.nulls(len(some), pa.int32()),
                "before": (some // size).astype(np.int32),
                "behind": (some % size).astype(np.int32),
                "n": total[some],
            }
        )

    found = checkpointed(rows.mapInArrow(task, schema))
    known = found.filter(F.col("word").isNull()).select(F.col("before").alias("a"), F.col("behind").alias("b"), "n")
    met = _met(found.filter(F.col("word").isNotNull()).drop("n"), lexicon, vocabulary.base)
    pairs = F.array(F.struct(F.col("before").alias("a"), F.col("class").alias("b")), F.struct(F.col("class").alias("a"), F.col("behind").alias("b")))
    moved = met.select(F.explode(pairs).alias("p")).select("p.a", "p.b", F.lit(1).cast("bigint").alias("n")).filter(F.col("b").isNotNull())
    out = np.zeros((size, size), np.int64)
    for r in known.unionByName(moved).groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        out[r.a, r.b] = r.n
    return out


def _most_frequent(counts: DataFrame, most: int) -> tuple[int | None, int]:
    """A count that at most ``most`` words reach (null: no such), and how many do."""
    band = F.floor(F.log2("n") * 16).cast("int").alias("band")
    kept, least = 0, None
    for b in counts.groupBy(band).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("band")).collect():
        if kept + b.words > most:
            break
        kept, least = kept + b.words, b.least
    return least, kept


def fit(
    docs: DataFrame, text: str = "text", clustered: int = CLUSTERED, frequent: int = FREQUENT, least: int = LEAST
) -> tuple[Model, DataFrame]:
    """The model, and the checkpointed lexicon: (word, n, class) of all words."""
    spark = docs.sparkSession
    counts = checkpointed(count_tokens(docs, text))
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(clustered).toArrow()
    words, n = (np.asarray(top.column(c).to_numpy()) for c in ("word", "n"))
    words, clustered = words.view(np.uint64), len(words)
    order = np.argsort(words)
    seeds = Vocabulary(words[order], n[order], order, clustered)
    pairs = count_pairs(docs, text, seeds)
    of = exchange(pairs, clustered)
    classes = int(of.max()) - SHAPES
    joint = np.zeros((classes + SHAPES + 1,) * 2)
    np.add.at(joint, (of[:, None], of[None, :]), pairs)
    near = Vocabulary(seeds.words, seeds.counts, of[seeds.symbols], classes)
    first = spark.createDataFrame(
        [(int(w), int(k), int(c)) for w, k, c in zip(words.view(np.int64), n, of[:clustered], strict=True)], "word bigint, n bigint, class int"
    )
    lexicon = checkpointed(assign(docs, text, near, joint, least, int(totals.v)).unionByName(first))
    from_count, _ = _most_frequent(lexicon, frequent)
    known = (lexicon.filter(F.col("n") >= from_count) if from_count is not None else lexicon.limit(0)).toArrow()
    word, times, kind = (np.asarray(known.column(c).to_numpy()) for c in ("word", "n", "class"))
    order = np.argsort(word.view(np.uint64))
    vocabulary = Vocabulary(word.view(np.uint64)[order], times[order], kind[order], classes)
    joint = count_moves(docs, text, vocabulary, lexicon).astype(float)
    size = len(joint)
    share = (joint.sum(axis=0) + 1) / (joint.sum() + size)
    smooth = (joint + PRIOR * share) / (joint.sum(axis=1, keepdims=True) + PRIOR)
    mass = np.zeros(size)
    mass[classes:-1] = 1.0
    for r in lexicon.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        mass[r["class"]] += r["n"] + (r["v"] if r["class"] >= classes else 0)
    ends = int(pairs[:, -1].sum())
    return Model(vocabulary, np.log10(smooth), np.log10(np.maximum(mass, 1)), int(totals.n) + ends, int(totals.v) + (ends > 0), ends), lexicon


def score(docs: DataFrame, model: Model, lexicon: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_tokens, n_known, base_score and score (log10 probabilities of the text).

    A task scores frequent words and the moves between them by itself, once per
    whole text.  Rarer words leave with the classes beside them and meet their
    counts and classes in a join; texts are not shuffled.
    """
    docs = make_room(docs, "n_tokens", "n_known", "base_score", "score")
    own = docs.columns
    held = [f"c{i}" for i in range(len(own))]
    spark = docs.sparkSession
    shared = Shared(spark, model)
    renamed = docs.toDF(*held).withColumn("__text_bytes", text_bytes(held[own.index(text)]))
    size, base = model.vocabulary.size, model.vocabulary.base

    def make():
        model = shared.value
        vocabulary = model.vocabulary
        per_token = np.log10(model.tokens + model.distinct + 1.0)

        def step(block: Block) -> dict:
            chain, h, shape, symbol, count, doc = sequence(block, vocabulary)
            size = np.bincount(doc, minlength=len(block))
            first = np.cumsum(size + 1) - size - 1
            hole, rare = _rare_words(chain, h, shape, count, doc)
            moves = np.where(hole[:-1] | hole[1:], 0.0, model.moves[chain[:-1], chain[1:]])
            seen = np.maximum(count, 0)
            emitted = np.where(count < 0, 0.0, np.log10(np.maximum(seen + (symbol >= vocabulary.base), 1)) - model.mass[symbol])
            base = np.where(count > 0, np.log10(seen + 1.0), 0.0) - per_token
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc[count < 0], minlength=len(block)))]).astype(np.int32)
            return {
                "n_tokens": (size + 1).astype(np.int64),
                "known": np.bincount(doc, count > 0, len(block)).astype(np.int64) + (model.end > 0),
                "base": np.bincount(doc, base, len(block)) + np.log10(model.end + 1.0) - per_token,
                "own": np.add.reduceat(moves, first) + np.bincount(doc, emitted, len(block)),
                "rare": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(rare.values()), list(rare))),
            }

        return step

    entry = "struct<place: bigint, word: bigint, shape: int, before: int, behind: int>"
    schema = f"n_tokens bigint, known bigint, base double, own double, rare array<{entry}>"
    rest = [c for c in held if c != held[own.index(text)]]
    local = map_blocks(renamed, "__text_bytes", make, schema, rest)
    local = checkpointed(local.withColumn("__row", F.monotonically_increasing_id()))
    rare = local.select(F.col("__row").alias("row"), F.explode("rare").alias("x")).select("row", "x.*")
    table = F.array(*[F.lit(float(x)) for x in model.mass])
    cells = [(a, b, float(model.moves[a, b])) for a in range(size) for b in range(size)]
    moves = F.broadcast(spark.createDataFrame(cells, "a int, b int, p double"))  # classes squared
    into, out = moves.toDF("before", "class", "into"), moves.toDF("class", "behind", "out")
    met = _met(rare, lexicon, base).join(into, ["before", "class"], "left").join(out, ["class", "behind"], "left")
    shaped = (F.col("class") >= base).cast("int")
    emitted = F.log10(F.greatest(F.col("n") + shaped, F.lit(1))) - F.get(table, F.col("class"))
    met = met.groupBy(F.col("row").alias("__row")).agg(
        F.sum(F.log10(F.col("n") + 1.0)).alias("more"),
        F.sum(emitted + F.col("into") + F.coalesce("out", F.lit(0.0))).alias("scored"),
        F.count_if(F.col("n") > 0).alias("seen"),
    )
    whole = local.drop("rare").join(met, "__row", "left")
    return whole.select(
        *rest,
        "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("own") + F.coalesce("scored", F.lit(0.0))).alias("score"),
    ).toDF(*[c for c in own if c != text], "n_tokens", "n_known", "base_score", "score")


def held_out(doc_id: str = "doc_id") -> Column:
    return crc_share(doc_id, 7) == 2


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model, lexicon = fit(docs.filter(~held_out()))
    found = score(docs, model, lexicon)
    return found.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
