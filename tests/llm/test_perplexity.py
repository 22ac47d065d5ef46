import math
import re
from collections import Counter

import numpy as np

from tidemark.llm import perplexity as pp
from tidemark.llm.blocks import VISIBLE_BYTES, Block

from .awkward import TEXTS, awkward, empty

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD)), None]


def test_base_score_against_brute_force(spark):
    taught = [(k, f"the cat {k % 5} sat on the mat {k % 3}.") for k in range(40)]
    rows = TEXTS + [(100, "THE cat sat on a dog")]
    for frequent in (pp.FREQUENT, 4):  # with 4, most counts are joined
        model, counts = pp.fit(awkward(spark, taught), clustered=3, frequent=frequent)
        known = Counter(w for _, t in taught for w in tokens(t))
        n, v = sum(known.values()), len(known)
        assert (model.tokens, model.distinct) == (n, v)
        found = pp.score(awkward(spark, rows), model, counts)
        got = sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found.collect())
        want = []
        for _, t in rows:
            w = tokens(t)
            want.append((len(w), sum(known[x] > 0 for x in w), round(sum(math.log10((known[x] + 1) / (n + v + 1)) for x in w), 6)))
        assert got == sorted(want)


def brute_score(text, model, lexicon):
    """The sum over tokens of class transition and emission, word by word."""
    classes = model.vocabulary.base
    out, before = 0.0, model.vocabulary.size - 1
    for w in tokens(text):
        if w is None:
            kind, n, size = model.vocabulary.size - 1, 1, 1
        else:
            block = Block(0, [w.encode()])
            h, s, e, _ = block.tokens(VISIBLE_BYTES)
            n, kind = lexicon.get(int(h[0]), (0, classes + int(pp.shapes(block, s, e)[0])))
            inside = [m for m, k in lexicon.values() if k == kind]
            size = sum(inside) + (len(inside) + 1 if kind >= classes else 0)
            n += kind >= classes
        out += model.moves[before, kind] + math.log10(n) - math.log10(size)
        before = kind
    return out


def test_score_against_brute_force(spark):
    taught = [(k, f"the cat {k % 5} sat on the mat {k % 3}. {'rare' * (k % 7)} {k} {k % 11}x end") for k in range(40)]
    rows = TEXTS + [(100, "THE cat sat on a dog"), (101, "2x 3x 4x cat new words 5x"), (102, " ".join(f"{k % 11}x {k}" for k in range(500)))]
    for frequent in (pp.FREQUENT, 6, 0):
        model, lexicon = pp.fit(awkward(spark, taught), clustered=5, frequent=frequent, least=2)
        table = {r.word % 2**64: (r.n, r["class"]) for r in lexicon.collect()}
        assert sum(n for n, _ in table.values()) == model.tokens - model.end
        got = sorted(round(r.score, 6) for r in pp.score(awkward(spark, rows), model, lexicon).collect())
        assert got == sorted(round(brute_score(t, model, table), 6) for _, t in rows)
        if frequent == pp.FREQUENT:
            first = model.moves
        assert np.allclose(first, model.moves)  # transitions of rare words are counted alike


def test_probabilities_after_each_class_sum_to_one(spark):
    taught = awkward(spark, [(k, f"red apple {k} green pear {k % 4}") for k in range(30)])
    for frequent in (1000, 3):
        model, lexicon = pp.fit(taught, clustered=4, frequent=frequent)
        mass = np.zeros(model.vocabulary.size)
        for r in lexicon.collect():
            mass[r["class"]] += (r.n + (r["class"] >= model.vocabulary.base)) / 10 ** model.mass[r["class"]]
        # an unseen word of a shape takes the rest of its class
        mass[model.vocabulary.base : -1] += 1 / 10 ** model.mass[model.vocabulary.base : -1]
        mass[-1] = 1
        assert np.allclose((10**model.moves) @ mass, 1)


def test_words_join_the_class_where_they_gain_most(spark):
    draw = np.random.default_rng(5)
    joint = draw.integers(0, 9, (7, 7)).astype(float)
    entries = [(w, s, int(draw.integers(1, 5))) for w in range(6) for s in sorted(draw.choice(14, 5, replace=False))]
    word, side, n = (np.array(x) for x in zip(*entries, strict=True))

    def likelihood(pairs, left, right):
        return pp.g(pairs).sum() - pp.g(left).sum() - pp.g(right).sum()

    got = pp.gains(joint, 4, word, side, n, 6)
    for w in range(6):
        for c in range(4):
            pairs, left, right = joint.copy(), joint.sum(axis=1), joint.sum(axis=0)
            for _, s, k in (x for x in entries if x[0] == w):
                cell = (s, c) if s < 7 else (c, s - 7)
                pairs[cell] += k
                if s < 7:
                    right[c] += k
                else:
                    left[c] += k
            want = likelihood(pairs, left, right) - likelihood(joint, joint.sum(axis=1), joint.sum(axis=0))
            assert abs(got[w, c] - want) < 1e-9


def test_rarer_words_join_the_classes_of_their_kind(spark):
    draw = np.random.default_rng(6)
    rows = []
    for k in range(300):  # a word of the first kind always precedes one of the second; both kinds have rare words
        kinds = [[f"{kind}{min(int(draw.integers(60)), int(draw.integers(60)))}q" for _ in range(20)] for kind in "ab"]
        rows.append((k, " ".join(f"{a} {b}" for a, b in zip(*kinds, strict=True))))
    model, lexicon = pp.fit(awkward(spark, rows), clustered=20, least=3)
    hashes = {int(Block(0, [w.encode()]).tokens(VISIBLE_BYTES)[0][0]): w for w in {w for _, t in rows for w in t.split()}}
    of = {hashes[r.word % 2**64]: (r.n, r["class"]) for r in lexicon.collect()}
    learned = {w: c for w, (n, c) in of.items() if n >= 3}
    assert len(learned) > 80 and all(c < model.vocabulary.base for c in learned.values())
    kinds = [{c for w, c in learned.items() if w[0] == kind} for kind in "ab"]
    assert not kinds[0] & kinds[1]
    assert all(c >= model.vocabulary.base for w, (n, c) in of.items() if n < 3)


def test_exchange_finds_the_classes():
    draw = np.random.default_rng(4)
    pairs = np.zeros((41, 41), np.int64)
    for _ in range(40_000):  # even words precede odd ones
        a, b = 2 * draw.integers(20), 2 * draw.integers(20) + 1
        pairs[a, b] += 1
        pairs[b, 2 * draw.integers(20)] += 1
    of = pp.exchange(pairs, 40, classes=2)
    assert len(set(of[:40:2])) == 1 == len(set(of[1:40:2])) and of[0] != of[1]


def test_classes_beat_the_base(spark):
    rows = [(k, " ".join(f"a{(k * j) % 13} b{(k + j) % 11}" for j in range(30))) for k in range(60)]
    docs = awkward(spark, rows)
    model, counts = pp.fit(docs.filter(~pp.held_out()), clustered=30)
    held = pp.score(docs, model, counts).filter(pp.held_out()).collect()
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(spark):
    model, counts = pp.fit(empty(spark))
    rows = pp.score(awkward(spark), model, counts).collect()
    assert len(rows) == len(TEXTS) and {(r.n_known, r.base_score) for r in rows} == {(0, 0.0)}
    assert pp.score(empty(spark), *pp.fit(awkward(spark))).count() == 0
