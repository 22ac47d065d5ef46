import re
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit

from .awkward import CLASH, TEXTS, awkward, empty

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, labels):
    """rows: (doc_id, text, lang)."""
    out = defaultdict(lambda: [0] * 6)
    removed = defaultdict(int)
    parts = {lang or "" for _, _, lang in rows}
    for i, raw, lang in rows:
        text = raw or ""
        w = WORD.findall(text)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w)}
        fails["C"] = 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)
        fails["D"] = bool(re.search("[#$%&*|]", text))
        fails["E"] = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)
        good = any(j == i and i is not None and q == 1 for j, q, _ in labels)
        toxic = any(j == i and i is not None and x == 1 for j, _, x in labels)
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                now = fails[f] and not gone
                row = out[lang or "", order, step]
                for k, yes in enumerate([not fails[f] and not gone, now, fails[f] and gone, [x for x in fails if fails[x]] == [f], now and good, now and toxic]):
                    row[k] += yes
                removed[lang or "", f] += now
                gone |= fails[f]
    return {(p, o, s): (*out[p, o, s], removed[p, o[s - 1]]) for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)}


def answers(frame):
    rows = frame.collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(found) == len(rows)
    return found


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").withColumn("part", F.lit("x"))


LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (5, None, 1), (7, 1, 1), (10, 1, 0), (None, 1, 1), (99, 1, 1)]


def test_against_brute_force(spark):
    words = [f"w{k}" for k in range(120)]
    texts = [
        *TEXTS,
        (10, " ".join(words)),
        (11, " ".join(words)),
        (11, " ".join(words)),
        (12, " ".join(words) + " $"),
        (13, " ".join(["Same", "WORDS"] * 60)),
        (14, " ".join(w.upper() for w in words) + " \x00é"),
        (-3, " ".join(words)),
        (15, ""),
        (None, ""),
    ]
    lang = F.when(F.col("doc_id") % 4 == 0, "en").when(F.col("doc_id") % 4 == 1, "fr").when(F.col("doc_id") % 4 == 2, "")
    docs = awkward(spark, texts, lang=lang).withColumns({c: F.lit("x") for c in ("mask", "name", "good", "least")})
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert answers(filter_audit.audit(filter_audit.masks(docs, labelled(spark, LABELS)))) == brute(rows, LABELS)


def test_many_parts_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 2)
    rows = [(i, "a b c #" if i % 3 else "A B", f"p{i % 7}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    assert answers(filter_audit.audit(filter_audit.masks(docs, labelled(spark, [])))) == brute(rows, [])
    none = empty(spark)
    assert filter_audit.audit(filter_audit.masks(none, labelled(spark, LABELS))).count() == 0


def test_fields_hold_large_counts(spark):
    """Sums beyond 32 bits stay inside their fields."""
    packed = filter_audit.packed_outcomes("AB")
    total = sum(n * packed[kind] for kind, n in {0: 1 << 40, 1: (1 << 63) - 1, 3 | 4: 5}.items())
    fields = [total >> 64 * i & (1 << 64) - 1 for i in range(2 * 2 * 6)]
    # order AB, step 1 (A): kept, removed, redundant, unique, good lost, toxic lost
    assert fields[:6] == [1 << 40, (1 << 63) + 4, 0, (1 << 63) - 1, 5, 0]
    # step 2 (B)
    assert fields[6:12] == [1 << 40, 0, 5, 0, 0, 0]
    with pytest.raises(OverflowError):
        total.to_bytes(8, "little")


def test_other_filters(spark):
    rows = spark.createDataFrame([("x", 1, True), ("x", 3, False), (None, 2, None)], "part string, mask int, good boolean").withColumn("toxic", F.lit(False))
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.good_lost, r.shapley) for r in filter_audit.audit(rows, "PQ").collect()}
    assert found["x", "PQ", 1] == (0, 2, 0, 1, 3) and found["x", "QP", 2] == (0, 1, 1, 1, 3)
    assert found["", "PQ", 2] == (0, 1, 0, 0, 2) and len(found) == 8 and "key" in CLASH
