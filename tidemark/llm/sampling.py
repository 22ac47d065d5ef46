"""Consistent weighted sampling: gamma-based samples of weighted terms.

For sample k a term has r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), fixed by its
hash.  A weight w gives t = floor(ln w / r + b) and
ln a = ln c - r (t - b) - r; the term with the least a is the sample, with its t.
Two weighted sets agree in a sample with a probability equal to their
generalised Jaccard similarity.

The gamma variates come from a fixed table of 2^16 entries that (term, k) is
hashed into.  For the few weights that most terms have, a table of their ln a and
t makes a sample one lookup a term.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.blocks import BLOCK_DOCS, bounds, mix

TABLE = 1 << 16
SEED = 20240229
_LOW = np.uint64(0xFFFFFFFF)
#: A document number of a block and 52 bits of a term's hash share 64 bits.
_DOC_SHIFT = np.uint64(64 - (BLOCK_DOCS - 1).bit_length())


class Sampler:
    """``usual`` are the weights with tables of their own."""

    def __init__(self, samples: int, usual: tuple[float, ...] = (1.0,), seed: int = SEED):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.r = draw.gamma(2.0, 1.0, TABLE)
        self.log_c = np.log(draw.gamma(2.0, 1.0, TABLE))
        self.b = draw.random(TABLE)
        self.odd = draw.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.usual = np.array(usual)
        every = np.arange(TABLE)
        self.tables = np.concatenate([self._keys(every, np.full(TABLE, np.log(w))) for w in usual])

    def _keys(self, slot: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
        """ln a, in an order-keeping form, as the high half, and a hash of t as the low half."""
        r, b = self.r[slot], self.b[slot]
        t = np.floor(log_weight / r + b)
        bits = (self.log_c[slot] - r * (t - b) - r).astype(np.float32).view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
        step = t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1)
        return (bits.astype(np.uint64) << np.uint64(32)) | (step & _LOW)

    def samples(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
        """docs x samples array of uint32 (0 for documents without terms); rows must be grouped by ``doc``."""
        first = bounds(doc)
        out = np.zeros((docs, len(self.odd)), np.uint32)
        if not len(first):
            return out
        spread = mix(term)
        low = spread & _LOW
        kind = np.minimum(np.searchsorted(self.usual, weight), len(self.usual) - 1)
        table = kind * TABLE
        other = np.flatnonzero(self.usual[kind] != weight)
        log_other = np.log(weight[other])
        for k, odd in enumerate(self.odd):
            slot = ((spread * odd) >> np.uint64(48)).astype(np.int64)
            key = self.tables[table + slot]
            if len(other):
                key[other] = self._keys(slot[other], log_other)
            out[doc[first], k] = np.minimum.reduceat(key ^ low, first) & _LOW
        return out


def count_terms(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, term) in order, with counts; terms keep 52 bits of their hash."""
    key = (doc.astype(np.uint64) << _DOC_SHIFT) | (term >> np.uint64(12))
    key.sort()
    first = bounds(key)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> _DOC_SHIFT).astype(np.int64), key & np.uint64((1 << 52) - 1), count
