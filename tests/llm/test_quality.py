import numpy as np

from tidemark.llm import quality
from tidemark.llm.blocks import Block

from .awkward import TEXTS, awkward, empty

GOOD = "A plain sentence stands here, and another follows it.\nIt has words of usual length.\n"
BAD = "BUY!! NOW!! ### $$$ %%%\nspam spam spam spam spam spam | | | 777\n"


def labelled(spark, n=60):
    docs = awkward(spark, [(k, (GOOD if k % 2 else BAD) * (1 + k % 4)) for k in range(n)])
    return docs, spark.createDataFrame([(k, k % 2) for k in range(n)], "doc_id bigint, quality int")


def test_held_out_documents(spark):
    docs, labels = labelled(spark)
    field = quality.fit(docs, labels.filter(~quality.held_out()))
    rows = quality.score(docs, field).filter(quality.held_out()).collect()
    assert rows and all((r.quality_score >= 0.3) == bool(r.doc_id % 2) for r in rows)
    assert all(0 <= r.quality_score <= 1 for r in quality.score(awkward(spark), field).collect())
    assert quality.score(awkward(spark), field).count() == len(TEXTS) and quality.score(empty(spark), field).count() == 0


def test_lines_are_judged_with_their_neighbours(spark):
    docs, labels = labelled(spark)
    field = quality.fit(docs, labels)
    rows = {r.doc_id: r for r in quality.score(awkward(spark, [(1, GOOD * 3 + BAD), (2, GOOD * 3), (3, BAD * 3)]), field).collect()}
    assert rows[3].quality_score < rows[1].quality_score < rows[2].quality_score
    assert rows[2].good_lines > rows[1].good_lines > rows[3].good_lines


def test_forward_backward_against_all_labellings():
    draw = np.random.default_rng(0)
    doc = np.array([0, 0, 0, 0, 1, 2, 2])
    scores, moves = draw.normal(size=(7, 2)), draw.normal(size=(2, 2))
    marginal, expected = quality.forward_backward(scores, moves, doc)
    total, pairs = np.zeros((7, 2)), np.zeros((2, 2))
    for d in range(3):
        at = np.flatnonzero(doc == d)
        ways = [[int(b) for b in np.binary_repr(k, len(at))] for k in range(2 ** len(at))]
        mass = np.array([np.exp(sum(scores[i, y] for i, y in zip(at, w, strict=True)) + sum(moves[a, b] for a, b in zip(w, w[1:], strict=False))) for w in ways])
        for w, p in zip(ways, mass / mass.sum(), strict=True):
            for i, y in zip(at, w, strict=True):
                total[i, y] += p
            for a, b in zip(w, w[1:], strict=False):
                pairs[a, b] += p
    assert np.allclose(marginal, total) and np.allclose(expected, pairs)


def test_one_class_or_no_labels(spark):
    docs, labels = labelled(spark, 6)
    for taught, value in ((labels.filter("quality = 1"), 1.0), (labels.filter("quality = 5"), 0.5)):
        rows = quality.score(docs, quality.fit(docs, taught)).collect()
        assert {r.quality_score for r in rows} == {value}


def test_features_of_a_block_are_those_of_single_texts():
    texts = [t.encode() for t in (GOOD, "", BAD, "\n\n", "x")]
    whole = quality.line_features(Block(0, texts))[0]
    assert np.allclose(whole, np.concatenate([quality.line_features(Block(0, [t]))[0] for t in texts]))
