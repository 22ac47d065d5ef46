"""Language identification as a mixture of languages per document.

Training counts byte trigrams per language over all training texts.  A document
is a mixture of languages: expectation-maximisation estimates the proportions
from the trigrams' likelihoods, and a language joins the document's set only if
the penalised likelihood gains by it.  The step that starts each round also
bounds it: by concavity the gain from adding languages is at most the largest
directional derivative, so most documents need no iterations.

Defined cases: a null text, an empty text and a text without a letter are
``und`` with score 0, and so is everything if no training row has a language;
rows with a null language teach nothing; repeated rows are counted and predicted
each on their own; a long text is a block of its own; no documents give no rows; a
column with the name of a result is replaced by it.  Ties go to the language that
sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.blocks import LOWER, Block, Shared, blocks, bounds, crc_share, make_room, map_blocks, small_batches, text_bytes

UNDETERMINED = "und"
#: A language joins a document's set if the log-likelihood gains this many times log(trigrams).
PENALTY = 10.0
ROUNDS = 12
#: Languages a model may have; a model holds one number per language and seen trigram.
MAX_LANGUAGES = 1000

_SYMBOLS = LOWER.copy()
_SYMBOLS[: ord("a")] = 0
_SYMBOLS[ord("A") : ord("Z") + 1] = LOWER[ord("A") : ord("Z") + 1]
_SYMBOLS[ord("z") + 1 : 128] = 0
_SYMBOLS[ord("[") : ord("a")] = 0
_SYMBOLS[_SYMBOLS > 0] -= ord("a") - 1
_SYMBOLS[128:] -= 5
ALPHABET = int(_SYMBOLS.max()) + 1


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code, document) of every byte trigram; bytes that are no letters count as blanks, and blanks surround a text."""
    data = np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    s = _SYMBOLS[data].astype(np.int32)
    code = (s[:-2] * ALPHABET + s[1:-1]) * ALPHABET + s[2:]
    keep = (owner[:-2] == owner[2:]) & (code > 0)
    return code[keep], owner[:-2][keep]


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # sorted
    likelihood: np.ndarray  # (codes + 1) x languages; row 0 is for unseen trigrams


def count_trigrams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, code, n) over whole texts; each task adds up before the shuffle."""
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), text_bytes(text).alias("raw"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list[np.ndarray]] = {}

        def merged(parts: list[np.ndarray]) -> list[np.ndarray]:
            code, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.zeros(len(code), np.int64)
            np.add.at(n, at, np.concatenate([p[1] for p in parts]))
            return [np.stack([code, n])]

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for block in blocks(batch.column(1).to_pylist()):
                mine = langs[block.first : block.first + len(block)]
                for name in set(mine):
                    code, _ = trigrams([t for t, x in zip(block.texts, mine, strict=True) if x == name])
                    parts = totals.setdefault(name, [])
                    parts.append(np.stack(np.unique(code.astype(np.int64), return_counts=True)))
                    if len(parts) > 16:
                        totals[name] = merged(parts)
        for name, parts in totals.items():
            code, n = merged(parts)[0]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(code)), "code": code.astype(np.int32), "n": n})

    partial = rows.mapInArrow(task, "lang string, code int, n bigint")
    return partial.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Model:
    """The trigram model; its size is bounded by the trigram alphabet and ``MAX_LANGUAGES``."""
    table = count_trigrams(docs, text, lang).toArrow()
    names = np.array(table.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(names))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; a model takes {MAX_LANGUAGES} at most")
    code, n = table.column("code").to_numpy(), table.column("n").to_numpy()
    codes, row = np.unique(code, return_inverse=True)
    counts = np.zeros((len(codes) + 1, len(languages)))
    for k, name in enumerate(languages):
        counts[row[names == name] + 1, k] = n[names == name]
    if languages:
        counts = (counts + smoothing) / (counts.sum(axis=0) + smoothing * len(counts))
    return Model(languages, codes, counts.astype(np.float32))


def mixtures(model: Model, texts: list[bytes], penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(documents x languages proportions, share of each document's trigrams that training has seen)."""
    p = model.likelihood.astype(np.float64)
    size = len(model.languages)
    code, owner = trigrams(texts)
    at = np.minimum(np.searchsorted(model.codes, code), len(model.codes) - 1)
    row = np.where(model.codes[at] == code, at + 1, 0)
    key, count = np.unique(owner.astype(np.int64) * len(p) + row, return_counts=True)
    doc, row, count = key // len(p), key % len(p), count.astype(np.float64)
    docs = len(texts)
    total = np.bincount(doc, count, docs)
    seen = np.bincount(doc, count * (row > 0), docs) / np.maximum(total, 1)

    def per_doc(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        out = np.zeros((docs, values.shape[1]))
        first = bounds(owner)
        if len(first):
            out[owner[first]] = np.add.reduceat(values, first, axis=0)
        return out

    single = per_doc(count[:, None] * np.log(p)[row], doc)
    best = single.argmax(axis=1)
    share = np.zeros((docs, size))
    share[np.arange(docs), best] = 1.0
    gain_of = penalty * np.log(total + 2)
    value = single[np.arange(docs), best]
    open_docs = np.ones(docs, bool)
    for _ in range(size - 1):
        mine = open_docs[doc]
        if not mine.any():
            break
        d, r, c = doc[mine], row[mine], count[mine]
        ratio = p[r] / (p[r] * share[d]).sum(axis=1)[:, None]
        slope = np.where(share > 0, -np.inf, per_doc(c[:, None] * ratio, d) - total[:, None])
        joins = slope.argmax(axis=1)
        open_docs &= slope[np.arange(docs), joins] > gain_of
        if not open_docs.any():
            break
        mine = open_docs[doc]
        d, r, c = doc[mine], row[mine], count[mine]
        trial = share.copy()
        k = np.flatnonzero(open_docs)
        trial[k] *= 0.7
        trial[k, joins[k]] = 0.3
        chances = p[r]
        for _ in range(rounds):
            part = chances * trial[d]
            trial = per_doc(part * (c / part.sum(axis=1))[:, None], d) / np.maximum(total, 1)[:, None]
        reached = per_doc((c * np.log((chances * trial[d]).sum(axis=1)))[:, None], d)[:, 0]
        open_docs &= reached - value > gain_of
        share[open_docs] = trial[open_docs]
        value[open_docs] = reached[open_docs]
    return share, seen


def predict(docs: DataFrame, model: Model, text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """``docs`` plus lang_pred, score and languages (proportions of the selected set).

    The score is the proportion of the leading language times the share of the
    document's trigrams that training has seen.
    """
    docs = make_room(docs, "lang_pred", "score", "languages")
    own = docs.columns
    held = [f"c{i}" for i in range(len(own))]
    shared = Shared(docs.sparkSession, model)
    renamed = docs.toDF(*held)
    source = renamed[held[own.index(text)]].cast("string")
    renamed = renamed.withColumn("__letter", F.coalesce(source.rlike(r"\p{L}"), F.lit(False)))
    renamed = renamed.withColumn("__text_bytes", text_bytes(held[own.index(text)]))

    def make():
        model = shared.value

        def step(block: Block) -> dict:
            if not model.languages:
                none = [None] * len(block)
                return {"lang_pred": [UNDETERMINED] * len(block), "score": [0.0] * len(block), "languages": pa.array(none, pa.map_(pa.string(), pa.float64()))}
            share, seen = mixtures(model, block.texts, penalty)
            best = share.argmax(axis=1)
            chosen = [[(model.languages[k], float(s[k])) for k in np.flatnonzero(s)] for s in share]
            return {
                "lang_pred": [model.languages[k] for k in best],
                "score": np.clip(share.max(axis=1) * seen, 0, 1),
                "languages": pa.array(chosen, pa.map_(pa.string(), pa.float64())),
            }

        return step

    found = map_blocks(renamed, "__text_bytes", make, "lang_pred string, score double, languages map<string, double>", [*held, "__letter"])
    letter = F.col("__letter")
    found = found.withColumns(
        {
            "lang_pred": F.when(letter, F.col("lang_pred")).otherwise(UNDETERMINED),
            "score": F.when(letter, F.col("score")).otherwise(0.0),
            "languages": F.when(letter, F.col("languages")),
        }
    )
    return found.drop("__letter").toDF(*own, "lang_pred", "score", "languages")


def held_out(doc_id: str = "doc_id") -> Column:
    return crc_share(doc_id, 3) == 1


def query(spark, folder: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs.filter(~held_out()))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
