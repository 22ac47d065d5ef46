import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import relative_parse as rp

from .awkward import TEXTS, awkward, empty

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=13):
    first: dict[tuple, int] = {}
    spelled = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in spelled:
        for k in range(len(w) - window + 1):
            name = tuple(w[k : k + window])
            if i is not None:
                first[name] = min(first.get(name, i), i)
    out = []
    for i, w in spelled:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((-1 if i is None else i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def answers(docs):
    found = rp.remove_repeats(docs).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in found)


def sharing(seed, docs=40, vocabulary=30):
    """Texts that share passages of many lengths around the limit, some cut, shifted, changed or repeated."""
    draw = random.Random(seed)
    words = [f"W{k}" if k % 3 else f"é{k}" for k in range(vocabulary)] + ["a\x1cb", "."]
    shared = [[draw.choice(words) for _ in range(n)] for n in (12, 13, 14, 20, 26, 40, 90)]
    rows = []
    for i in range(docs):
        text = []
        for _ in range(draw.randint(0, 4)):
            text += [draw.choice(words) for _ in range(draw.randint(0, 15))]
            s = list(draw.choice(shared))
            if draw.random() < 0.4:
                s[draw.randrange(len(s))] = draw.choice(words)
            text += s[draw.randint(0, 3) :]
        rows.append((draw.choice([i, i, i - 100, 3]), draw.choice([" ", "  ", "\n", "\t"]).join(text)))
    return rows + [(7, rows[5][1]), (900, rows[5][1]), (None, rows[6][1]), (None, rows[6][1]), (901, rows[6][1] + " end")]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = sharing(seed)
    assert answers(awkward(spark, rows)) == brute(rows)


def test_one_word_again_and_again(spark):
    rows = [(k, " ".join(["x"] * n)) for k, n in enumerate((12, 13, 14, 40, 12, 200))] + [(9, "y " * 30 + "x " * 13)]
    assert answers(awkward(spark, rows)) == brute(rows)


@pytest.mark.parametrize("crowd", [0, 2])
def test_crowds_take_the_other_path(spark, monkeypatch, crowd):
    monkeypatch.setattr(rp, "CROWD", crowd)
    monkeypatch.setattr(rp, "HELD_WINDOWS", 50 if crowd else 1 << 20)
    again = [(200 + k, " ".join(["a b"] * (20 + k % 3) + [f"end{k}"])) for k in range(12)]
    rows = sharing(11) + again
    assert answers(awkward(spark, rows)) == brute(rows)


def test_small_reference_blocks(spark, monkeypatch):
    monkeypatch.setattr(rp, "BLOCK", 10)
    rows = sharing(12, docs=25)
    assert answers(awkward(spark, rows)) == brute(rows)


def test_awkward_rows(spark):
    rows = [*TEXTS, (20, "start " + TEXTS[9][1][:4000]), (-5, TEXTS[9][1][2000:9000]), (21, TEXTS[9][1])]
    assert answers(awkward(spark, rows)) == brute(rows)
    assert rp.remove_repeats(empty(spark)).count() == 0


def test_long_texts_are_ranked_in_pieces(monkeypatch):
    draw = np.random.default_rng(1)
    words = draw.integers(0, 50, 3000).astype(np.uint64)
    doc = np.repeat([0, 1, 2], [1500, 7, 1493])
    spread = lambda a: {(s, p, r) for p, r, f, t in zip(*a[1:], strict=True) for s in range(f, t + 1)}
    whole = spread(rp.anchors(words, doc))
    monkeypatch.setattr(rp, "PIECE", 100)
    assert spread(rp.anchors(words, doc)) == whole
    assert {s for s, _, _ in whole} == set(range(1500 - 12)) | set(range(1507, 3000 - 12))


def test_factors_are_the_longest_from_their_source():
    """A factor goes on as far as its source does; windows across its end are found as well."""
    a, b = [b"a%d" % k for k in range(30)], [b"b%d" % k for k in range(30)]
    passages = [a, b, a[:20] + [b"-"] * 3, a[10:25] + b[3:25], a[17:30] + b[:13]]
    passages.append(a[20:30] + b[:10])  # has a window that no factor of passage 4 holds whole
    numbers = {w: k for k, w in enumerate(a + b + [b"-"])}
    names = [rp.gram_ranks(np.array([numbers[w] for w in p], np.uint64), 13).tobytes() for p in passages]
    block = rp.ReferenceBlock(names, np.zeros(6, np.int64), np.array([1, 2, 3, 4, 9, 5]))
    assert sorted(block.factors()) == [(2, 0, 20), (3, 0, 15), (3, 15, 37), (4, 0, 13), (4, 3, 23), (4, 13, 26)]
    alone = rp.ReferenceBlock(names, np.arange(6), np.array([1, 2, 3, 4, 9, 5]))
    assert not list(alone.factors()) and all(len(x) == 0 for x in alone.spans())


def test_equal_numbers_of_texts_are_numbered_anew(spark, monkeypatch):
    real, seeds = rp.F.xxhash64, []

    def clashing(*columns):
        seeds.append(columns)
        return rp.F.lit(1).cast("bigint") if len(seeds) == 1 else real(*columns)

    monkeypatch.setattr(rp.F, "xxhash64", clashing)
    rows = sharing(4, docs=10)
    assert answers(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows) and len(seeds) > 1
