import hashlib

import numpy as np

from tidemark.llm import fingerprint as fp
from tidemark.llm.sampling import Sampler

from .awkward import TEXTS, awkward, empty


def test_collision_rate_is_the_generalised_jaccard_similarity():
    draw = np.random.default_rng(2)
    term = draw.integers(0, 1 << 52, 400).astype(np.uint64)
    sampler = Sampler(3000, (1.0, 2.5))
    for a, b in ((1.0, 1.0), (2.5, 1.0), (0.3, 3.7), (7.0, 6.0)):
        left = np.concatenate([np.full(200, a), np.full(100, 1.0)])
        right = np.concatenate([np.full(200, b), np.full(100, 2.5)])
        ids = np.concatenate([term[:200], term[200:300]])
        other = np.concatenate([term[:200], term[300:400]])
        zero = np.zeros(300, np.int64)
        same = (sampler.samples(zero, ids, left, 1) == sampler.samples(zero, other, right, 1)).mean()
        shared = np.minimum(left, right)[:200].sum()
        assert abs(same - shared / (left.sum() + right.sum() - shared)) < 0.04


def test_next_and_edited_against_brute_force(spark):
    rows = [(i, t) for i, t in TEXTS if i != 5] + [(5, "the same row again")] + [(k, f"text number {k} of some") for k in range(20, 60)]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for parts in (1, 4, 7):
        got = {r.doc_id: r for r in fp.with_next(awkward(spark, rows), parts=parts).collect()}
        assert len(got) == len(rows)
        single = {r.doc_id: r.fingerprint for r in fp.fingerprints(awkward(spark, rows)).collect()}
        changed = []
        for k, (i, t) in enumerate(order):
            t, (j, n) = t or "", order[(k + 1) % len(order)]
            half = len(t) // 2
            edited = t[: len(t) - half] + (n or "")[:half]
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert r.fingerprint == single[i] == got[i].fingerprint
            share = np.mean([r.fingerprint[x : x + 4] == got[j].fingerprint[x : x + 4] for x in range(0, len(r.fingerprint), 4)])
            assert abs(r.near_next - share) < 1e-9
            share = np.mean([r.fingerprint[x : x + 4] == r.edited_fingerprint[x : x + 4] for x in range(0, len(r.fingerprint), 4)])
            assert abs(r.near_edited - share) < 1e-9
            changed.append((i, edited))
        again = {r.doc_id: r.fingerprint for r in fp.fingerprints(awkward(spark, changed)).collect()}
        assert again == {i: r.edited_fingerprint for i, r in got.items()}


def test_parts_grow_with_the_text(spark):
    docs = awkward(spark, [(k, "ten bytes." * 10) for k in range(200)])
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fp.parts_for(docs, "text") == least == fp.parts_for(empty(spark), "text")
    assert fp.parts_for(docs, "text", 1000) == max(20, least)


def test_likeness_and_equal_texts(spark):
    frame = fp.fingerprints(awkward(spark, [(1, "one two three four"), (2, "one two three four"), (3, "five six")]))
    a, b, c = (r.fingerprint for r in frame.orderBy("doc_id").collect())
    assert a == b != c
    pair = spark.createDataFrame([(a, b, c)], "a string, b string, c string").select(fp.likeness("a", "b").alias("x"), fp.likeness("a", "c").alias("y")).first()
    assert pair.x == 1 and pair.y < 0.2


def test_awkward_and_empty(spark):
    assert fp.with_next(awkward(spark)).count() == len(TEXTS)
    assert fp.with_next(empty(spark)).count() == 0 == fp.fingerprints(empty(spark)).count()
    alone = fp.with_next(awkward(spark, [(1, "only one")])).first()
    assert alone.near_next == 1.0
