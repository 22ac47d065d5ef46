import hashlib
import random

import numpy as np

from tidemark.llm import repeats

from .awkward import TEXTS, awkward, empty


def brute(texts, length=200):
    seen, out = {}, []
    for t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k : k + length]] = seen.get(t[k : k + length], 0) + 1
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def answers(spark, rows, tmp_path):
    awkward(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = repeats.query(spark, str(tmp_path))
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())


def expected(rows):
    got = brute([(t or "").encode() for _, t in rows])
    return sorted((-1 if i is None else i, *x) for (i, _), x in zip(rows, got, strict=True))


def copies(seed=5, docs=14):
    """Texts over a small alphabet that share stretches of many lengths around the limit."""
    draw = random.Random(seed)
    shared = ["".join(draw.choice("abcé ") for _ in range(n)) for n in (190, 199, 200, 201, 264, 420, 900)]
    rows = []
    for i in range(docs):
        text = ""
        for _ in range(draw.randint(0, 4)):
            text += "".join(draw.choice("abcd ") for _ in range(draw.randint(0, 150)))
            s = draw.choice(shared)
            cut = draw.randint(0, 40)
            text += s[cut:] if draw.random() < 0.5 else s
        rows.append((i, text))
    return rows


def test_against_brute_force(spark, tmp_path):
    rows = copies() + [(90, "xy" * 300), (91, "z" * 199), (92, "z" * 200), (93, "q" * 201)]
    assert answers(spark, rows, tmp_path) == expected(rows)


def test_crowds_take_the_other_path(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", 2)
    rows = copies(6)
    assert answers(spark, rows, tmp_path) == expected(rows)


def test_long_texts_are_ranked_in_pieces():
    draw = np.random.default_rng(1)
    raw = draw.integers(97, 100, 5000).astype(np.uint8)
    whole = repeats.anchors(raw)
    old, repeats.PIECE = repeats.PIECE, 700
    try:
        cut = repeats.anchors(raw)
    finally:
        repeats.PIECE = old
    spread = lambda a: {(s, p) for p, _, f, t in zip(*a, strict=True) for s in range(f, t + 1)}
    assert spread(whole) == spread(cut)
    assert {s for s, _ in spread(whole)} == set(range(len(raw) - 199))


def test_awkward_rows(spark, tmp_path):
    rows = [*TEXTS, (20, "r" * 30 + TEXTS[9][1][:5000])]
    rows = [(i, t) for i, t in rows if i != 7] + [(7, TEXTS[9][1][:7000]), (7, TEXTS[9][1][:7000])]
    assert answers(spark, rows, tmp_path) == expected(rows)


def test_empty_table(spark):
    assert repeats.remove_repeats(empty(spark)).count() == 0
