"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items build one automaton (per block of
items).  Every document's words stream through it; the longest match that ends
at each word says which words stand in an occurrence of a test window.

A window is ``window`` consecutive words of an item; an item of fewer words,
but not none, is one window.  Words are those of ``blocks.WORD_BYTES`` after
A-Z is lower-cased.

Defined cases: a null or empty text has no words and no hits; repeated rows are
judged each on their own; null item texts have no windows; a null item id counts
as the id ''; with no items nothing is hit; no documents give no rows.  Other columns pass through
unread; one with the name of a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import WORD_BYTES, Block, Shared, hash_tokens, make_room, map_blocks, small_batches, text_bytes

WINDOW = 13
#: A document is contaminated if hit words are at least this share (1 / 20) of its words.
COVERAGE_PARTS = 20
#: Words of one block of items; more items make more passes in the same job.
BLOCK_WORDS = 1_000_000


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items that own each window."""

    def __init__(self, window: int):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.owners: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        self.words: dict[int, int] = {}
        self.shortest = window

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        twin = self._state(self.length[state] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = twin
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = twin
            state = self.link[state]
        return twin

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            target = self.step[last][word]
            self.link[new] = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        return new

    def add_all(self, items: list[tuple[str, list[int]]]) -> None:
        """Add the items' words, given as hashes, then note who owns each window."""
        spelled = [(item, [self.words.setdefault(w, len(self.words)) for w in words]) for item, words in items if len(words)]
        for _, words in spelled:
            last = 0
            for word in words:
                last = self._extend(last, word)
        for item, words in spelled:
            size = min(self.window, len(words))
            self.shortest = min(self.shortest, size)
            for at, state in self._ends(words, size):
                if len(words) < self.window:
                    self.short.setdefault(state, []).append((size, item))
                else:
                    self.owners.setdefault(state, set()).add(item)

    def _ends(self, words: list[int], size: int) -> Iterator[tuple[int, int]]:
        for i, length, state in self.matches(words):
            if length >= size:
                yield i, self._suffix(state, size)

    def _suffix(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what ``state`` has matched."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, longest match that ends there, its state)."""
        state = length = 0
        step, link, longest = self.step, self.link, self.length
        for i, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                length = longest[state]
            to = step[state].get(word)
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            yield i, length, state

    def finish(self) -> None:
        """Note which states have a short item among their suffixes; sort the vocabulary."""
        self.has_short = [False] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            self.has_short[state] = state in self.short or self.has_short[self.link[state]]
        hashes = np.fromiter(self.words, np.uint64, len(self.words))
        order = np.argsort(hashes)
        self.vocabulary, self.numbers = hashes[order], order

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; -1 for words of no item."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, self.numbers[at], -1)

    def hits(self, hashes: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [first, last) word ranges inside occurrences of windows, and the items they are of."""
        numbers = self.number(hashes)
        known = np.diff((numbers >= 0).astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
        long_enough = ends - starts >= self.shortest
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for start, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            for i, length, state in self.matches(numbers[start:end].tolist()):
                size = 0
                if length >= self.window:
                    owners = self.owners.get(self._suffix(state, self.window))
                    if owners:
                        items |= owners
                        size = self.window
                if self.has_short[state]:
                    up = state
                    while up > 0:
                        for words, item in self.short.get(up, ()):
                            if words <= length:
                                items.add(item)
                                size = max(size, words)
                        up = self.link[up]
                if size:
                    last = start + i + 1
                    first = last - size
                    while found and found[-1][1] >= first:
                        first = min(first, found.pop()[0])
                    found.append((first, last))
        return found, items


def _automata(items: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[SuffixAutomaton]:
    """One automaton per block of items; the driver holds one block at a time."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), text_bytes(text).alias("t"))
    held, size = [], 0

    def build() -> SuffixAutomaton:
        automaton = SuffixAutomaton(window)
        automaton.add_all(held)
        automaton.finish()
        return automaton

    for row in named.toLocalIterator():
        words = hash_tokens(bytes(row.t), WORD_BYTES)[0].tolist()
        if held and size + len(words) > block_words:
            yield build()
            held, size = [], 0
        held.append((row.i, words))
        size += len(words)
    if held:
        yield build()


def scan(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` plus n_words, n_hit, hit_items (sorted) and hit_spans ([first, last) bytes of the UTF-8 text, and how many words that is).

    The documents are read once and never shuffled.  Each block of items is
    broadcast (its size is bounded by ``block_words``) and makes one more pass
    over the words inside the same tasks.
    """
    spark = docs.sparkSession
    shared = [Shared(spark, a) for a in _automata(items, item_id, item_text, window, block_words)]
    docs = make_room(docs, "n_words", "n_hit", "hit_items", "hit_spans")
    own = docs.columns

    def make():
        def step(block: Block) -> dict:
            hashes, starts, ends, doc = block.tokens(WORD_BYTES)
            cut = np.searchsorted(doc, np.arange(len(block) + 1))
            out = {"n_words": [], "n_hit": [], "hit_items": [], "hit_spans": []}
            for k in range(len(block)):
                mine = slice(cut[k], cut[k + 1])
                ranges, names = [], set()
                for model in shared:
                    more, who = model.value.hits(hashes[mine])
                    ranges += more
                    names |= who
                merged: list[list[int]] = []
                for first, last in sorted(ranges):
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], last)
                    else:
                        merged.append([first, last])
                at = block.starts[k]
                out["n_words"].append(int(cut[k + 1] - cut[k]))
                out["n_hit"].append(sum(b - a for a, b in merged))
                out["hit_items"].append(sorted(names))
                out["hit_spans"].append(
                    [{"first": int(starts[mine][a] - at), "last": int(ends[mine][b - 1] - at), "words": b - a} for a, b in merged]
                )
            spans = pa.array(out["hit_spans"], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("words", pa.int64())])))
            return out | {"hit_items": pa.array(out["hit_items"], pa.list_(pa.string())), "hit_spans": spans}

        return step

    schema = "n_words bigint, n_hit bigint, hit_items array<string>, hit_spans array<struct<first: bigint, last: bigint, words: bigint>>"
    raw = "__text_bytes"
    renamed = docs.toDF(*[f"c{i}" for i in range(len(own))])
    renamed = renamed.withColumn(raw, text_bytes(f"c{own.index(text)}"))
    found = map_blocks(renamed, raw, make, schema, [f"c{i}" for i in range(len(own))])
    return found.toDF(*own, "n_words", "n_hit", "hit_items", "hit_spans")


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit", parts: int = COVERAGE_PARTS):
    """The coverage limit: some word is hit, and hit words are at least 1 / ``parts`` of all."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * parts >= F.col(n_words))


def without_spans(text: str = "text", spans: str = "hit_spans", words: int = 1):
    """The text without hit spans of ``words`` words or more; a column expression."""
    raw = F.col(text).cast("binary")
    long = F.filter(spans, lambda s: s["words"] >= words)
    cuts = F.concat(F.array(F.lit(0).cast("long")), F.transform(long, lambda s: s["last"]))
    stops = F.concat(F.transform(long, lambda s: s["first"]), F.array(F.octet_length(raw).cast("long")))
    pieces = F.transform(
        F.arrays_zip(cuts.alias("a"), stops.alias("b")),
        lambda p: F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")).cast("string"),
    )
    return F.array_join(pieces, "")


def query(spark, folder: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    found = scan(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


ORACLE = r"""
WITH words AS (
  SELECT doc_id, i AS pos, w[i] AS word, len(w) AS n
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents), unnest(range(1, len(w) + 1)) AS u(i)
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS phrase
  FROM item_words, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows
), whole AS (SELECT doc_id, list(word ORDER BY pos) AS w FROM words GROUP BY doc_id
), phrases AS (
  SELECT doc_id, size, i AS pos, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM whole, sizes, unnest(range(1, len(w) - size + 2)) AS u(i) WHERE len(w) >= size
), found AS (SELECT p.doc_id, p.pos, p.size, x.item_id FROM phrases p JOIN windows x ON p.size = x.size AND p.phrase = x.phrase
), hit AS (SELECT doc_id, count(DISTINCT pos + k) AS n_hit FROM (SELECT DISTINCT doc_id, pos, size FROM found), unnest(range(0, size)) AS u(k) GROUP BY doc_id
), items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
), sized AS (SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(n_words, 0) AS contaminated
FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
