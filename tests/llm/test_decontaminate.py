import re

from tidemark.llm import decontaminate as dc

from .awkward import TEXTS, awkward, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window=13):
    doc, hit, names = words(text), set(), set()
    for item, body in items:
        w = words(body)
        size = min(window, len(w))
        for k in range(len(w) - size + 1) if w else ():
            for at in range(len(doc) - size + 1):
                if doc[at : at + size] == w[k : k + size]:
                    hit |= set(range(at, at + size))
                    names.add(str(item or ""))
    return len(doc), len(hit), sorted(names)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string")


def check(spark, texts, rows, **settings):
    docs = awkward(spark, list(enumerate(texts)))
    for row in dc.scan(docs, items(spark, rows), **settings).collect():
        assert (row.n_words, row.n_hit, row.hit_items) == brute(row.text, rows, settings.get("window", 13))


def test_windows_short_items_and_overlaps(spark):
    a = " ".join(f"w{k}" for k in range(20))
    rows = [("long", a), ("short", "X y, z"), ("one", "solo"), ("inner", "w5 w6"), ("none", "..."), (None, "lost item"), ("null", None)]
    texts = [
        a,
        "pre " + a + " w5 w6 post",
        " ".join(f"w{k}" for k in range(12)),
        "x y z x y z solo",
        "w1 w2 w3 w5 w6 w7 lost item",
        None,
        "",
    ]
    check(spark, texts, rows)


def test_repeated_structure_against_brute_force(spark):
    rows = [("p", "a b a b a b a b"), ("q", "b a b a"), ("r", "a a a"), ("s", "a b c a b c a b d")]
    texts = ["a b a b a b", "b a b a b a b a b", "a a a a b c a b d", "c a b c a b c a b d a", "a b c a b d"]
    for window in (1, 2, 3, 4, 13):
        check(spark, texts, rows, window=window)


def test_blocks_of_items_give_the_same(spark):
    rows = [(str(k), f"w{k} w{k + 1} w{k + 2}") for k in range(9)]
    check(spark, ["w1 w2 w3 w4 w5 w6", "w8 w9 w10 w0 w1 w2"], rows, block_words=4)


def test_awkward_rows_and_spans(spark):
    rows = [("i", "same row again"), ("j", "straße 中文")]
    found = dc.scan(awkward(spark), items(spark, rows)).collect()
    assert len(found) == len(TEXTS)
    for row in found:
        assert (row.n_words, row.n_hit, row.hit_items) == brute(row.text, rows)
        raw = (row.text or "").encode()
        assert sum(len(words(raw[s.first : s.last].decode())) for s in row.hit_spans) == row.n_hit
    cut = dc.scan(awkward(spark), items(spark, rows)).withColumn("text", dc.without_spans()).collect()
    assert {"the  and again and again", "ÀÉ ñandú über  текст"} <= {r.text for r in cut}


def test_empty_tables(spark):
    assert dc.scan(empty(spark), items(spark, [("i", "x")])).count() == 0
    assert {r.n_hit for r in dc.scan(awkward(spark), items(spark, [])).collect()} == {0}
