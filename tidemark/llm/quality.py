"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad, judged by its own features and those of the lines
before and after it, and by the label of its neighbours.  Training takes the
lines of a bounded sample of labelled documents, each with its document's label;
prediction runs on whole texts.  A document's score is the length-weighted mean
of its lines' forward-backward marginals for "good".

Defined cases: a null or empty text is one empty line; rows with a null label or
a null id teach nothing; with no labelled rows, or only one
class, every score is the share of good labels (0.5 without any); repeated rows
are scored each on their own; a long text is a block of its own; no documents give no
rows; a column with the name of a result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.blocks import VISIBLE_BYTES, Block, Shared, bounds, crc_share, make_room, map_blocks, text_bytes

#: Labelled documents that training reads at most, about.
TRAINING_DOCUMENTS = 6_000
THRESHOLD = 0.3

_KINDS = {
    "letter": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "upper": [*range(65, 91)],
    "digit": [*range(48, 58)],
    "blank": [32, 9],
    "stop": [ord(c) for c in ".,;:?"],
    "shout": [ord("!")],
    "symbol": [ord(c) for c in "#$%&*@^~+=<>"],
    "frame": [ord(c) for c in "|_\\/{}[]()\"'"],
}
_TABLE = np.zeros((len(_KINDS), 256), np.uint8)
for _row, _codes in enumerate(_KINDS.values()):
    _TABLE[_row, _codes] = 1
OWN = len(_KINDS) + 6


def line_features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line with its neighbours', length of each line, document of each line)."""
    data = np.frombuffer(block.data, np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts
    doc = np.searchsorted(block.ends, starts, side="right")
    own = np.zeros((len(starts), OWN))
    for k in range(len(_KINDS)):
        own[:, k] = np.add.reduceat(_TABLE[k][data], starts, dtype=np.int64)
    letters = np.maximum(own[:, 0], 1)
    own[:, 1] /= letters
    others = [0, *range(2, len(_KINDS))]
    own[:, others] /= np.maximum(size, 1)[:, None]
    hashes, at, to, _ = block.tokens(VISIBLE_BYTES)
    line = np.searchsorted(ends, at)
    words = np.bincount(line, minlength=len(starts))
    order = np.lexsort((hashes, line))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(starts))
    spread = np.maximum(words, 1)
    k = len(_KINDS)
    own[:, k] = np.log1p(size)
    own[:, k + 1] = np.log1p(words)
    own[:, k + 2] = np.minimum(np.bincount(line, to - at, len(starts)) / spread, 50)
    own[:, k + 3] = distinct / spread
    # lines that the same document has more than once
    powers = np.cumsum(np.bincount(line, minlength=len(starts)))
    first_word = powers - words
    content = np.zeros(len(starts), np.uint64)
    filled = words > 0
    if filled.any():
        content[filled] = np.add.reduceat(hashes * (np.arange(len(hashes)) - first_word[line] + 1).astype(np.uint64), first_word[filled])
    order = np.lexsort((content, doc))
    change = np.ones(len(order), bool)
    change[1:] = (content[order][1:] != content[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    group = np.cumsum(change) - 1
    copies = np.empty(len(order))
    copies[order] = np.bincount(group)[group]
    own[:, k + 4] = np.log(copies) * filled
    own[:, k + 5] = 1.0
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = doc[1:] == doc[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return np.hstack([own, before, after]), size, doc


@dataclass
class Field:
    """Weights of "good" over "bad" per feature, and the 2 x 2 transition scores (bad, good)."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    prior: float | None = None

    def scores(self, features: np.ndarray) -> np.ndarray:
        good = ((features - self.centre) / self.scale) @ self.weights
        return np.stack([np.zeros(len(good)), good], axis=1)


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def forward_backward(scores: np.ndarray, moves: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals of each line, expected moves summed over all); all documents advance line by line together."""
    first = bounds(doc)
    sizes = np.diff(np.append(first, len(doc)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    alpha, beta = scores.copy(), np.zeros_like(scores)
    alive = [int((sizes > t).sum()) for t in range(int(sizes[0]) if len(sizes) else 0)]
    for t, n in enumerate(alive[1:], 1):
        at = first[:n] + t
        alpha[at] += _log_add(alpha[at - 1][:, :, None] + moves, 1)
    for t in range(len(alive) - 1, 0, -1):
        at = first[: alive[t]] + t
        beta[at - 1] = _log_add(moves + (scores[at] + beta[at])[:, None, :], 2)
    both = alpha + beta
    total = _log_add(both, 1)
    marginal = np.exp(both - total[:, None])
    inner = np.ones(len(doc), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    pairs = alpha[at - 1][:, :, None] + moves + (scores[at] + beta[at])[:, None, :] - total[at][:, None, None]
    return marginal, np.exp(pairs).sum(axis=0)


def train(features: np.ndarray, doc: np.ndarray, label: np.ndarray, steps: int = 80, rate: float = 0.15, ridge: float = 1e-3) -> Field:
    """Maximum penalised likelihood by gradient steps with adaptive rates."""
    centre, scale = features.mean(axis=0), features.std(axis=0)
    constant = scale < 1e-9
    centre[constant], scale[constant] = 0.0, 1.0
    field = Field(centre, scale, np.zeros(features.shape[1]), np.zeros((2, 2)))
    x = (features - centre) / scale
    inner = doc[1:] == doc[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][inner], label[1:][inner]), 1)
    state = np.zeros((2, len(field.weights) + 4))
    for step in range(1, steps + 1):
        marginal, moves = forward_backward(np.stack([np.zeros(len(x)), x @ field.weights], axis=1), field.moves, doc)
        slope = np.concatenate([x.T @ (label - marginal[:, 1]), (seen - moves).ravel()]) / len(x)
        slope -= ridge * np.concatenate([field.weights, field.moves.ravel()])
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope**2
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        field.weights = field.weights + move[:-4]
        field.moves = field.moves + move[-4:].reshape(2, 2)
    return field


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", documents: int = TRAINING_DOCUMENTS) -> Field:
    """Fit on the whole texts of about ``documents`` labelled documents, drawn by a hash of the id.

    The drawn labels are few by that bound, so they are broadcast and the texts stay where they are.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    drawn = known.filter(draw < int(1_000_000 * min(1.0, documents / max(known.count(), 1))))
    sample = docs.select(F.col(doc_id).alias("id"), text_bytes(text).alias("raw")).join(F.broadcast(drawn), "id")

    def make():
        def step(block: Block) -> dict:
            x, _, doc = line_features(block)
            at = np.searchsorted(doc, np.arange(len(block) + 1))
            flat = [x[at[k] : at[k + 1]].astype(np.float32).tobytes() for k in range(len(block))]
            return {"x": pa.array(flat, pa.binary())}

        return step

    rows = map_blocks(sample, "raw", make, "x binary", ["y"]).toArrow()
    y = rows.column("y").to_numpy().astype(np.int64)
    parts = [np.frombuffer(b, np.float32).reshape(-1, 3 * OWN) for b in rows.column("x").to_pylist()]
    if len(set(y)) < 2:
        none = np.zeros(3 * OWN)
        return Field(none, none + 1, none, np.zeros((2, 2)), float(y.mean()) if len(y) else 0.5)
    sizes = [len(p) for p in parts]
    order = np.repeat(np.arange(len(parts)), sizes)
    return train(np.concatenate(parts).astype(np.float64), order, np.repeat(y, sizes))


def score(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` plus quality_score and good_lines (lines whose marginal is at least a half)."""
    docs = make_room(docs, "quality_score", "good_lines")
    own = docs.columns
    held = [f"c{i}" for i in range(len(own))]
    shared = Shared(docs.sparkSession, field)
    renamed = docs.toDF(*held).withColumn("__text_bytes", text_bytes(held[own.index(text)]))

    def make():
        field = shared.value

        def step(block: Block) -> dict:
            x, size, doc = line_features(block)
            if field.prior is None:
                good = forward_backward(field.scores(x), field.moves, doc)[0][:, 1]
            else:
                good = np.full(len(x), field.prior)
            first = bounds(doc)
            weight = size + 1.0
            value = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
            return {"quality_score": np.clip(value, 0, 1), "good_lines": np.add.reduceat((good >= 0.5).astype(np.int64), first)}

        return step

    found = map_blocks(renamed, "__text_bytes", make, "quality_score double, good_lines bigint", held)
    return found.toDF(*own, "quality_score", "good_lines")


def held_out(doc_id: str = "doc_id") -> Column:
    return crc_share(doc_id, 5) == 0


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    taught = labels.filter(~held_out() & F.col("quality").isNotNull())
    field = fit(docs, taught)
    found = score(docs, field)
    predicted = F.when(F.col("quality_score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), predicted)
