import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations as co

from .awkward import TEXTS, awkward, empty

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000):
    """rows: (text, lang)."""
    f = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                f.update((lang or ("und" if lang is None else ""), *w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang in {key[0] for key in f}:
        n = sum(c for key, c in f.items() if key[0] == lang and len(key) == 2)
        found = []
        for (own, *phrase), a in f.items():
            if own != lang or len(phrase) < 2 or a < least:
                continue
            if len(phrase) == 2 and any(c >= least and k[0] == lang and len(k) == 4 and phrase in ([*k[1:3]], [*k[2:4]]) and 100 * c >= 50 * a for k, c in f.items()):
                continue
            cuts = [(10**6 * a * a // (f[lang, *phrase[:k]] * f[lang, *phrase[k:]]), k, f[lang, *phrase[:k]], f[lang, *phrase[k:]]) for k in range(1, len(phrase))]
            score, _, l, r = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def answers(docs, **settings):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in co.collocations(docs, **settings).collect())


def prose(seed, docs=60):
    draw = random.Random(seed)
    words = ["The", "of", "new", "York", "city", "é", "ÀB", "x", "0", "end\x00", "a-b"]
    fixed = ["new york City", "of the", "x x", "x", "the end, of", "a-b é 0"]
    rows = []
    for k in range(docs):
        parts = [draw.choice(fixed) if draw.random() < 0.5 else draw.choice(words) for _ in range(draw.randint(0, 40))]
        rows.append((draw.choice([" ", "  ", "\t", " \t "]).join(p if draw.random() < 0.9 else p + draw.choice(".,;:!?\n\x0b\x0c\r") for p in parts), draw.choice(["en", "fr", None, "und", ""])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit(1) for c in ("name", "second", "a", "n", "rank", "word")}).repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = prose(seed)
    found = answers(frame(spark, rows))
    assert found == brute(rows) and len(found) > 20
    assert answers(frame(spark, rows), top=3, least=4) == brute(rows, 4, 3)


def test_small_chunks_and_buckets(spark, monkeypatch):
    for name, value in (("CHUNK", 50), ("BUCKET", 20), ("HOT", 20), ("FAN", 3)):
        monkeypatch.setattr(co, name, value)
    rows = prose(7)
    assert answers(frame(spark, rows)) == brute(rows)


def test_hot_pairs_are_dealt_by_three_words(spark):
    draw = random.Random(1)
    rows = [(" ".join(f"hot pair {draw.choice('abcdefgh')}" for _ in range(40)), "en") for _ in range(6)] + [("same " * 300, "en"), ("hot pair", "en")]
    assert answers(frame(spark, rows)) == brute(rows)


def test_scores_beyond_64_bits(spark):
    names = spark.createDataFrame([(2, "en", "big", 4 * 10**12), (6, "en", "pair", 5 * 10**12)], "name bigint, lang string, word string, n bigint")
    phrases = spark.createDataFrame([(2, 6, 0, 3 * 10**12)], "first bigint, second bigint, third bigint, a bigint")
    row = co._ranked(phrases, names, names.groupBy("lang").agg(F.sum("n").alias("n")), 5).collect()[0]
    assert (row.phrase, row.a, row.l, row.r, row.n, row.score) == ("big pair", 3 * 10**12, 4 * 10**12, 5 * 10**12, 9 * 10**12, 450_000)


def test_quicksort_finds_all_and_abandons_the_rest():
    draw = np.random.default_rng(3)
    names = draw.integers(2, 12, (4000, 3)).astype(np.uint64)
    names[draw.random(4000) < 0.2, 2] = 0
    weight = draw.integers(1, 4, 4000)
    expected = Counter()
    for row, w in zip(names.tolist(), weight.tolist(), strict=True):
        expected[tuple(row[:2])] += w
        if row[2]:
            expected[tuple(row)] += w
    found = {tuple(names[r, :words].tolist()): n for words, rows, counts in co.equal_partitions(names, weight, 9) for r, n in zip(rows.tolist(), counts.tolist(), strict=True)}
    assert found == {k: n for k, n in expected.items() if n >= 9}
    assert not list(co.equal_partitions(names[:0], weight[:0], 1))


def test_equal_names_are_named_anew(spark, monkeypatch):
    real, seeds = co._name, []

    def clashing(text, seed):
        seeds.append(seed)
        return real(text, seed)

    monkeypatch.setattr(co, "_name", clashing)
    rows = prose(2, 10)
    counted = co._counted
    monkeypatch.setattr(co, "_counted", lambda texts, seed: counted(texts, seed) if seed else counted(texts, seed).withColumn("high", F.struct(F.lit("x").alias("lang"), F.lit(b"y").alias("word"))))
    assert answers(frame(spark, rows), least=2) == brute(rows, 2)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert answers(docs, least=2) == brute(rows, 2)
    assert co.collocations(empty(spark)).count() == 0
    assert brute([]) == [] and len(TEXTS) > 5
