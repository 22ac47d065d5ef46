"""Collocations by multikey three-way quicksort of suffix pointers.

Texts are split at ``BREAKS`` into pieces and those into words, A-Z lower-cased.  A
suffix pointer stands for the words that begin at a place of a piece, down to
``DEPTH`` words.  Pointers are dealt by their leading words, so that all of a phrase
meet; there they are sorted word by word.  Each round splits every partition by a
pivot into smaller, equal and larger pointers; an equal partition has a phrase in
common, its size is the phrase's count, and it goes on to the next word.  Partitions
of fewer than ``least`` pointers are abandoned.

Words go by 64-bit names of (language, word).  One pass counts them, spells them
and finds that no two have one name (else all are named anew).  Equal pointers of a
chunk are one with a weight.  Pairs of leading words that have a thousandth of all
pointers or more are dealt by three words instead of two, and counted apart.

Defined cases: a null or empty text has no words; a null language is the language
``und``; repeated rows count each; ties of score and count go to the phrase that is
less in UTF-8 bytes; an empty table has no collocations.  A very long text is read
in one block and its pointers leave in chunks.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.blocks import LOWER, Block, blocks, bounds, mix, text_bytes
from tidemark.sources.scratch import checkpointed

DEPTH = 3
LEAST = 10
#: A phrase goes if a longer one that has it occurs at least half as often.
COVERED = (50, 100)
SCALE = 1_000_000
TOP = 2000
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Pointers that a task collects before it sends them, and pointers of a bucket at most, about.
CHUNK = 1 << 19
BUCKET = 1 << 20
#: A pair with so large a share (1 / HOT) of all pointers is dealt by three words.
HOT = 1000
#: Partitions by leading words that a bucket's sort begins with.
FAN = 1 << 12

_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
WORDS = ~_BREAK
WORDS[[0x20, 0x09]] = False
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_MARK = np.uint64(1)


def pointers(block: Block, languages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names, starts, ends, document): names is a row a pointer, its word and the ``DEPTH`` - 1 after it (0: none)."""
    hashes, starts, ends, doc = block.tokens(WORDS)
    word = mix(hashes ^ languages[doc]) | np.uint64(2)  # 0 and 1 are no word's
    names = np.zeros((len(word), DEPTH), np.uint64)
    names[:, 0] = word
    breaks = np.cumsum(_BREAK[np.frombuffer(block.data, np.uint8)])
    joined = np.ones(len(word), bool)
    for k in range(1, DEPTH):
        if len(word) <= k:
            break
        joined = joined[: len(word) - k].copy()
        joined &= breaks[ends[k - 1 : len(ends) - 1] - 1] == breaks[starts[k:]]
        names[: len(word) - k, k] = np.where(joined, word[k:], 0)
    return names, starts, ends, doc


def weighed(names: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows with their added weights; rows that differ stay apart whatever their hashes."""
    order = np.argsort(route(names, DEPTH))
    names, weight = names[order], weight[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return names[first], np.add.reduceat(weight, first) if len(first) else weight


def route(names: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(len(names), np.uint64)
    for k in range(words):
        out = mix(out * _ODD[k] + names[:, k])
    return out


def is_hot(names: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which rows begin with one of the pairs, given as sorted routes."""
    if not len(hot):
        return np.zeros(len(names), bool)
    pair = route(names, 2)
    return hot[np.minimum(np.searchsorted(hot, pair), len(hot) - 1)] == pair


def equal_partitions(names: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, rows, counts): phrases of two words or more, each by one of its rows, with the weights of all its rows.

    Multikey three-way quicksort of the rows, all partitions of a round at once.
    The middle row of a partition is its pivot.  Partitions of less than ``least``
    are left unsorted.
    """
    depth = names.shape[1]
    code = (route(names, 2) >> np.uint64(16)).astype(np.int64) % FAN
    row = np.argsort(code.astype(np.int16), kind="stable")
    first = bounds(code[row])
    size = np.diff(np.append(first, len(row)))
    level = np.zeros(len(first), np.int64)
    weight = weight.astype(np.float64)  # exact below 2^53
    while len(row):
        part = np.repeat(np.arange(len(size)), size)
        key = names[row, level[part]]
        pivot_row = row[first + size // 2]
        pivot = names[pivot_row, level][part]
        side = part * 3 + 1 + (key > pivot) - (key < pivot)
        weights = np.bincount(side, weight[row], 3 * len(size)).reshape(-1, 3)
        # an equal partition has one word more in common; 0 is the end of a piece
        alike = (weights[:, 1] >= least) & (names[pivot_row, level] != 0)
        for words in range(2, depth + 1):
            some = alike & (level == words - 1)
            if some.any():
                yield words, pivot_row[some], weights[some, 1].astype(np.int64)
        goes_on = weights >= least
        goes_on[:, 1] = alike & (level + 1 < depth)
        stay = goes_on.ravel()[side]
        row, side = row[stay], side[stay]
        row = row[np.argsort(side, kind="stable")]
        sizes = np.bincount(side, minlength=3 * len(goes_on))
        level = (np.repeat(level, 3).reshape(-1, 3) + [0, 1, 0]).ravel()[sizes > 0]
        size = sizes[sizes > 0]
        first = np.cumsum(size) - size


def _chunks_of(batches: Iterator[pa.RecordBatch], seed: int, spell: bool = False) -> Iterator[tuple[np.ndarray, dict]]:
    """Pointers' names, about ``CHUNK`` at a time, and how the new words are spelled: name -> (language, word)."""
    held, size = [], 0
    spelled: dict[int, tuple[str, bytes]] = {}
    for batch in batches:
        lang = batch.column(1).dictionary_encode()
        kinds = lang.dictionary.to_pylist()
        salts = np.array([_name(k, seed) for k in kinds], np.uint64)
        for block in blocks(batch.column(0).to_pylist()):
            code = lang.indices.to_numpy()[block.first : block.first + len(block)]
            names, starts, ends, doc = pointers(block, salts[code])
            found, at = np.unique(names[:, 0], return_index=True) if spell else (names[:0, 0], np.zeros(0, np.int64))
            low = LOWER[np.frombuffer(block.data, np.uint8)].tobytes()
            for name, a, b, d in zip(found.tolist(), starts[at].tolist(), ends[at].tolist(), doc[at].tolist(), strict=True):
                if name not in spelled:
                    spelled[name] = (kinds[code[d]], low[a:b])
            held.append(names)
            size += len(names)
            if size >= CHUNK:
                whole, held, size = np.concatenate(held), [], 0
                yield whole, spelled
                whole, spelled = None, {}
    if size:
        yield np.concatenate(held), spelled


def _name(text: str, seed: int) -> np.uint64:
    data = np.frombuffer(text.encode(), np.uint8).astype(np.uint64)
    out = np.full(1, 0xA0761D6478BD642F ^ seed, np.uint64)
    for x in data:
        out = mix(out * _ODD[0] + x + np.uint64(1))
    return out[0]


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(text_bytes(text).alias("raw"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))


def _counted(texts: DataFrame, seed: int) -> DataFrame:
    """(name, second, lang, other_lang, word, other, n): every word (second 0), and pairs that are frequent in a chunk."""
    columns = ["name", "second", "lang", "word", "n"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, spelled in _chunks_of(batches, seed, spell=True):
            word, n = np.unique(names[:, 0], return_counts=True)
            lang, text = zip(*(spelled[w] for w in word.tolist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(np.zeros(len(word), np.int64)), pa.array(lang, pa.string()), pa.array(text, pa.binary()), pa.array(n)], columns
            )
            pair, at, n = np.unique(route(names, 2), return_index=True, return_counts=True)
            some = (n * 2 * HOT >= len(names)) & (names[at, 1] != 0)
            two = names[at[some]].view(np.int64)
            none = pa.nulls(len(two), pa.string()), pa.nulls(len(two), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1]), *none, pa.array(n[some])], columns)

    rows = texts.mapInArrow(task, "name bigint, second bigint, lang string, word binary, n bigint")
    spelled = F.struct("lang", "word")
    found = rows.groupBy("name", "second").agg(F.sum("n").alias("n"), F.min(spelled).alias("low"), F.max(spelled).alias("high"))
    return checkpointed(found)


def _dealt(texts: DataFrame, seed: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, n, packed): distinct pointers of a chunk with weights, by the leading words that their bucket goes by."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        for names, _ in _chunks_of(batches, seed):
            names = names[names[:, 1] != 0]
            names, weight = weighed(names, np.ones(len(names), np.int64))
            often = is_hot(names, hot)
            pairs, pair_weight = weighed(names[often] * np.array([1, 1, 0], np.uint64) + np.array([0, 0, 1], np.uint64), weight[often])
            deal = np.concatenate([np.where(often, route(names, DEPTH), route(names, 2)), route(pairs, 2)])
            names, weight = np.concatenate([names, pairs]), np.concatenate([weight, pair_weight])
            bucket = (deal % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            names, weight, bucket = names[order], weight[order], bucket[order]
            first = bounds(bucket)
            ends = np.append(first[1:], len(bucket))
            packed = [
                tool.compress(names[a:b].T.tobytes() + weight[a:b].astype(np.uint32).tobytes()) for a, b in zip(first.tolist(), ends.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_pydict({"bucket": bucket[first], "n": ends - first, "packed": pa.array(packed, pa.binary())})

    return texts.mapInArrow(task, "bucket bigint, n bigint, packed binary")


def _phrases(dealt: DataFrame, hot: np.ndarray, least: int) -> DataFrame:
    """(first, second, third, a): phrases of two words (third 0) and three that occur ``least`` times or more."""

    def sort(parts: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        names, weight = [], []
        for n, packed in parts:
            data = tool.decompress(packed)
            names.append(np.frombuffer(data, np.uint64, DEPTH * n).reshape(DEPTH, n).T)
            weight.append(np.frombuffer(data, np.uint32, n, 8 * DEPTH * n))
        names, weight = np.concatenate(names), np.concatenate(weight).astype(np.int64)
        marked = names[:, 2] == _MARK
        pairs, total = weighed(names[marked], weight[marked])
        yield as_batch(2, pairs[total >= least], total[total >= least])
        for words, row, n in equal_partitions(names[~marked], weight[~marked], least):
            found = names[~marked][row]
            whole = ~is_hot(found, hot) if words == 2 else np.ones(len(row), bool)
            yield as_batch(words, found[whole], n[whole])

    def as_batch(words: int, names: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        found = np.where(np.arange(DEPTH) < words, names, np.uint64(0)).astype(np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(found[:, k])) for k in range(DEPTH)), pa.array(n)], ["first", "second", "third", "a"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and held:
                    yield from sort(held)
                    held = []
                now = bucket
                held.append((n, packed))
        if held:
            yield from sort(held)

    placed = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return checkpointed(placed.mapInArrow(task, "first bigint, second bigint, third bigint, a bigint"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two and three words."""
    texts = _texts(docs, text, lang)
    for seed in count():
        counted = _counted(texts, seed)
        if counted.filter("low != high").isEmpty():
            break
    words = counted.filter("second = 0").select("name", "low.lang", F.col("low.word").cast("string").alias("word"), "n")
    totals = checkpointed(words.groupBy("lang").agg(F.sum("n").alias("n")))
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot = counted.filter((F.col("second") != 0) & (F.col("n") * HOT >= total)).select("name", "second").toArrow()  # at most HOT rows
    pairs = np.stack([hot.column(k).to_numpy() for k in (0, 1)] + [np.zeros(len(hot), np.int64)], axis=1).view(np.uint64)
    hot = np.sort(route(pairs, 2))
    buckets = max(total // BUCKET, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    phrases = _phrases(_dealt(texts, seed, hot, buckets), hot, least)
    return _ranked(phrases, checkpointed(words.filter(F.col("n") >= least)), totals, top)


def _ranked(phrases: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    two = phrases.filter("third = 0").select("first", "second", F.col("a").alias("f"))
    three = phrases.filter("third != 0")
    part, whole = COVERED
    longer = three.select("first", "second", "a").unionByName(three.select(F.col("second").alias("first"), F.col("third").alias("second"), "a"))
    longer = longer.groupBy("first", "second").agg(F.max("a").alias("longer"))
    kept = two.join(longer, ["first", "second"], "left").filter(f"longer IS NULL OR {whole} * longer < {part} * f")
    one = words.select("name", "lang", "word", F.col("n").alias("f"))

    def spelled(frame: DataFrame, columns: list[str]) -> DataFrame:
        for c in columns:
            own = one.toDF(c, f"lang_{c}", f"word_{c}", f"f_{c}")
            frame = frame.join(own if c == "first" else own.drop(f"lang_{c}"), c)
        return frame

    def cut(k: int, left: str, right: str):
        exact = [F.col(c).cast("decimal(18,0)") for c in ("a", "a", left, right)]
        top_part = (exact[0] * exact[1]).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
        score = F.call_function("div", top_part, exact[2] * exact[3])
        return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    pairs = spelled(kept.withColumnRenamed("f", "a"), ["first", "second"])
    pairs = pairs.select(F.col("lang_first").alias("lang"), F.concat_ws(" ", "word_first", "word_second").alias("phrase"), "a", cut(1, "f_first", "f_second").alias("cut"))
    triples = three.join(two.toDF("first", "second", "f_left"), ["first", "second"]).join(two.toDF("second", "third", "f_right"), ["second", "third"])
    triples = spelled(triples, ["first", "second", "third"])
    lowest = F.least(cut(1, "f_first", "f_right"), cut(2, "f_left", "f_third"))
    triples = triples.select(
        F.col("lang_first").alias("lang"), F.concat_ws(" ", "word_first", "word_second", "word_third").alias("phrase"), "a", lowest.alias("cut")
    )
    both = pairs.unionByName(triples).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, folder: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang"))


ORACLE = r"""
WITH pieces AS (
  SELECT row, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
), spelled AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (SELECT lang, x AS w, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM spelled) GROUP BY ALL
), two AS (
  SELECT lang, x.a AS a, x.b AS b, count(*) AS f FROM (
    SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: {'a': w[i], 'b': w[i + 1]})) AS x FROM spelled WHERE len(w) > 1) GROUP BY ALL
), three AS (
  SELECT lang, x.a AS a, x.b AS b, x.c AS c, count(*) AS f FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: {'a': w[i], 'b': w[i + 1], 'c': w[i + 2]})) AS x FROM spelled WHERE len(w) > 2) GROUP BY ALL
), longer AS (
  SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM three WHERE f >= 10 UNION ALL SELECT lang, b, c, f FROM three WHERE f >= 10) GROUP BY ALL
), cuts AS (
  SELECT t.lang, t.a || ' ' || t.b AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM two t JOIN words x ON t.lang = x.lang AND t.a = x.w JOIN words y ON t.lang = y.lang AND t.b = y.w
  LEFT JOIN longer g ON t.lang = g.lang AND t.a = g.a AND t.b = g.b WHERE t.f >= 10 AND (g.f IS NULL OR 100 * g.f < 50 * t.f)
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 1, x.f, y.f
  FROM three t JOIN words x ON t.lang = x.lang AND t.a = x.w JOIN two y ON t.lang = y.lang AND t.b = y.a AND t.c = y.b WHERE t.f >= 10
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 2, x.f, y.f
  FROM three t JOIN two x ON t.lang = x.lang AND t.a = x.a AND t.b = x.b JOIN words y ON t.lang = y.lang AND t.c = y.w WHERE t.f >= 10
), scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM words GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
