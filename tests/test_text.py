import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.stopwords import STOP_WORDS
from tidemark.functions.text import html_to_text, wiki_to_text
from tidemark.operators import terms as T
from tidemark.operators import sparse_rows
from tidemark.operators.reshaping import term_map
from tidemark.operators.concepts import (
    document_entries,
    document_rows,
    gramian_entries,
    heaviest_documents,
    project,
    rebuilt,
    rows_of_entries,
    top_documents,
    top_terms,
    truncated_svd,
    vector_entries,
)
from tidemark.sources import checkpointed
from tidemark.plans.latent_concepts import fit_concepts
from tidemark.sources import load_table

TEXTS = {
    1: "The river runs; the River bends. Rivers run",
    2: "Stones in the river, stones on the bank",
    3: "bank",
    4: "",
    5: "A bank lends money and the bank keeps money, 2 banks don't",
    6: "élan ÉLAN x1y naïve naïve",
}


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id BIGINT, text STRING")


def expected_tokens(text):
    words = re.split(r"[^\w']+|_", text.lower())
    return [w for w in words if len(w) > 2 and w.isalpha() and w not in STOP_WORDS]


def expected_counts():
    counts = {d: collections.Counter(expected_tokens(t)) for d, t in TEXTS.items()}
    return {d: c for d, c in counts.items() if sum(c.values()) > 1}


def test_stop_word_list():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 174
    assert "ours" in STOP_WORDS and "ourselves" in STOP_WORDS


def test_tokens(docs):
    got = {r.doc_id: r.tokens for r in T.document_tokens(docs).collect()}
    assert got == {d: expected_tokens(t) for d, t in TEXTS.items()}
    assert got[5] == ["bank", "lends", "money", "bank", "keeps", "money", "banks"]
    assert got[6] == ["élan", "élan", "naïve", "naïve"]


def test_term_frequency_against_counting(docs):
    tf = T.term_frequency(T.document_tokens(docs))
    got = {(r.doc_id, r.term): (r.tf, r.doc_total) for r in tf.collect()}
    counts = expected_counts()
    assert got == {(d, t): (n, sum(c.values())) for d, c in counts.items() for t, n in c.items()}
    assert 3 not in counts and 4 not in counts
    maps = {r.doc_id: r.terms for r in term_map(tf).collect()}
    assert maps == {d: dict(c) for d, c in counts.items()}


def test_no_shuffle_before_the_term_counts(docs):
    tf = T.term_frequency(T.document_tokens(docs))
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("regexp_extract_all(lower") == 1


def test_explode_does_not_compute_tokens_twice(spark):
    docs = load_table(spark, "/root/testdata/sf0.001", "documents")
    rows = T.explode_tokens(T.document_tokens(docs, stop_words=()))
    assert rows._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all(lower") == 1


@pytest.mark.parametrize("num_terms", [None, 3])
def test_vocabulary_and_weights(docs, num_terms):
    tf = T.term_frequency(T.document_tokens(docs))
    counts = expected_counts()
    df = collections.Counter(t for c in counts.values() for t in c)
    order = sorted(df, key=lambda t: (-df[t], t))[:num_terms]
    vocab = T.vocabulary(tf, num_terms)
    short = T.vocabulary(T.document_terms(T.document_tokens(docs)), num_terms)
    assert sorted(map(str, vocab.collect())) == sorted(map(str, short.collect()))
    got = {r.term_id: (r.term, r.df, pytest.approx(r.idf)) for r in vocab.collect()}
    assert got == {i: (t, df[t], math.log(len(counts) / df[t])) for i, t in enumerate(order)}
    weights = {(r.doc_id, r.term): r.weight for r in T.tfidf(tf, vocab, max_terms=num_terms).collect()}
    assert weights == {
        (d, t): pytest.approx(math.log(len(counts) / df[t]) * n / sum(c.values()))
        for d, c in counts.items() for t, n in c.items() if t in order
    }


def test_large_vocabulary_join_gives_the_same_weights(docs, monkeypatch):
    tf = T.term_frequency(T.document_tokens(docs))
    vocab = T.vocabulary(tf)
    small = sorted(map(str, T.tfidf(tf, vocab).collect()))
    monkeypatch.setattr("tidemark.operators.lookups.BROADCAST_ROWS", 1)
    monkeypatch.setattr(T, "HOT_TERMS", 2)
    assert sorted(map(str, T.tfidf(tf, vocab).collect())) == small


def test_lemmas_merge_counts(docs, spark):
    tf = T.term_frequency(T.document_tokens(docs))
    lemmas = spark.createDataFrame([("rivers", "river"), ("runs", "run"), ("banks", "bank")], "term STRING, lemma STRING")
    got = {(r.doc_id, r.term): r.tf for r in T.apply_lemmas(tf, lemmas).collect()}
    assert got[(1, "river")] == 3 and got[(1, "run")] == 2 and got[(5, "bank")] == 3
    assert sum(got.values()) == sum(sum(c.values()) for c in expected_counts().values())


def test_exclude_terms_from_a_table(docs, spark):
    rows = T.explode_tokens(T.document_tokens(docs))
    words = spark.createDataFrame([("bank",), ("bank",), ("river",)], "term STRING")
    from tidemark.operators.lookups import exclude_terms

    kept = {r.term for r in exclude_terms(rows, words).collect()}
    assert "bank" not in kept and "river" not in kept and "stones" in kept


def dense(docs, vocab):
    rows = document_rows(docs, vocab).orderBy("doc_id").collect()
    out = np.zeros((len(rows), vocab.count()))
    for place, r in enumerate(rows):
        assert list(r.terms) == sorted(r.terms)
        out[place, list(r.terms)] = r.weights
    return [r.doc_id for r in rows], out


def entries(frame, ids, key="doc_id"):
    found = frame.collect()
    out = np.zeros((len(ids), 1 + max(r.concept for r in found)))
    for r in found:
        out[ids.index(r[key]), r.concept] = r.weight
    return out


def test_rows_agree_with_the_long_form(docs):
    tokens = T.document_tokens(docs)
    tf = T.term_frequency(tokens)
    vocab = T.vocabulary(tf, 4)
    ids, matrix = dense(tokens, vocab)
    expected = np.zeros_like(matrix)
    for r in T.tfidf(tf, vocab, max_terms=4).collect():
        expected[ids.index(r.doc_id), r.term_id] = r.weight
    np.testing.assert_allclose(matrix, expected, atol=1e-12)
    assert len(ids) == docs.count()
    cells = gramian_entries(document_rows(tokens, vocab)).collect()
    assert len(cells) == 10 and all(c.i <= c.j for c in cells)
    for c in cells:
        assert c.value == pytest.approx((expected.T @ expected)[c.i, c.j], abs=1e-12)


@pytest.mark.parametrize("method", ["table", "blocks"])
def test_svd_rebuilds_the_matrix(docs, method):
    tokens = T.document_tokens(docs)
    vocab = T.vocabulary(T.term_frequency(tokens), 6)
    ids, matrix = dense(tokens, vocab)
    rows = document_rows(tokens, vocab)
    svd = truncated_svd(rows, 3, method=method)
    reference = np.linalg.svd(matrix, compute_uv=False)
    np.testing.assert_allclose(svd.sigma, reference[: len(svd.sigma)], atol=1e-8)
    v = entries(svd.term_weights(), list(range(6)), "term_id")
    assert all(v[np.abs(v[:, c]).argmax(), c] > 0 for c in range(v.shape[1]))
    full = truncated_svd(rows, 100, r_cond=1e-6, method=method)
    assert len(full.sigma) == np.linalg.matrix_rank(matrix)
    u, v = entries(full.document_weights(), ids), entries(full.term_weights(), list(range(6)), "term_id")
    np.testing.assert_allclose(u @ np.diag(full.sigma) @ v.T, matrix, atol=1e-7)


def random_rows(spark, m=300, n=400, seed=0):
    """Sparse rows whose singular values fall slowly, some rows without entries."""
    draw = np.random.default_rng(seed)
    full = (draw.standard_normal((m, 30)) * np.geomspace(5, 0.5, 30)) @ draw.standard_normal((30, n)) + draw.standard_normal((m, n))
    full *= draw.random((m, n)) < 0.2
    full[::50] = 0
    rows = [(int(k), [int(j) for j in np.flatnonzero(r)], [float(x) for x in r[r != 0]]) for k, r in enumerate(full)]
    return spark.createDataFrame(rows, "doc_id bigint, terms array<bigint>, weights array<double>").repartition(5), full


@pytest.mark.parametrize("method", ["table", "blocks"])
def test_iterated_svd_finds_the_leading_values(spark, method, monkeypatch):
    monkeypatch.setattr(sparse_rows, "COLUMN_BLOCK_BYTES", 20_000)
    monkeypatch.setattr(sparse_rows, "HELD_BYTES", 50_000)
    rows, full = random_rows(spark)
    reference = np.linalg.svd(full, compute_uv=False)
    svd = truncated_svd(checkpointed(rows), 6, method=method, terms=400)
    np.testing.assert_allclose(svd.sigma, reference[:6], rtol=1e-6)
    u, v = entries(svd.document_weights(), list(range(300))), entries(svd.term_weights(), list(range(400)), "term_id")
    np.testing.assert_allclose(u.T @ u, np.eye(6), atol=1e-8)
    np.testing.assert_allclose(v.T @ v, np.eye(6), atol=1e-8)
    np.testing.assert_allclose(full.T @ u, v * svd.sigma, atol=1e-2 * reference[0])


def test_projections_of_a_given_v_are_equal_both_ways(spark, monkeypatch):
    monkeypatch.setattr(sparse_rows, "COLUMN_BLOCK_BYTES", 2_000)
    rows, full = random_rows(spark, 60, 50)
    v = np.random.default_rng(5).standard_normal((50, 4))
    v[40:] = 0
    frame = spark.createDataFrame([(j, v[j].tolist()) for j in range(40)], "term_id bigint, w array<double>").select("term_id", sparse_rows.as_packed("w").alias("vector"))
    sigma = np.array([1.0, 2.0, 3.0, 4.0])
    for method in ("table", "blocks"):
        found = entries(vector_entries(project(rows, frame, sigma, method=method), "doc_id"), list(range(60)))
        np.testing.assert_allclose(found, full @ v / sigma, atol=1e-9)


def test_top_terms_and_documents(docs):
    model = fit_concepts(T.document_tokens(docs, keep=["text"]), 2, 6)
    terms = model.vocab.orderBy("term_id").collect()
    v = entries(model.svd.term_weights(), list(range(len(terms))), "term_id")
    got = {(r.concept, r.rank): (r.term, r.weight) for r in model.top_terms(3).collect()}
    for c in range(2):
        order = np.argsort(-v[:, c], kind="stable")[:3]
        assert [got[(c, i + 1)][1] for i in range(3)] == pytest.approx(list(v[order, c]))
        assert got[(c, 1)][0] == terms[order[0]].term
    best = model.top_documents(docs, 2, "text").collect()
    assert {(r.concept, r.rank) for r in best} == {(c, k) for c in range(2) for k in (1, 2)}
    assert all(r.text == TEXTS[r.doc_id] for r in best)
    assert model.singular_values().count() == 2


def test_nothing_stays_cached(docs, spark):
    kept = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = kept()
    model = fit_concepts(T.document_tokens(docs, keep=["text"]), 2, 6)
    model.top_documents(docs, 2, "text").collect()
    assert kept() == before


@pytest.mark.parametrize("n", [1, 3, 100])
def test_heaviest_documents_are_the_top_of_all_weights(spark, n):
    docs = load_table(spark, "/root/testdata/sf0.001", "documents").repartition(5, "doc_id")
    tokens = T.document_tokens(docs)
    rows = checkpointed(document_rows(tokens, T.vocabulary(T.term_frequency(tokens), 50)))
    svd = truncated_svd(rows, 4)
    documents = checkpointed(svd.documents)
    titles = docs.select("doc_id", F.col("source").alias("title"))
    some = heaviest_documents(documents, n)
    one = {(r.concept, r.rank): r.doc_id for r in top_documents(vector_entries(documents, "doc_id"), titles, n).collect()}
    other = {(r.concept, r.rank): r.doc_id for r in top_documents(some, titles, n).collect()}
    assert one == other and len(one) == 4 * min(n, rows.count())
    assert some.count() <= documents.rdd.getNumPartitions() * 4 * n


def test_ties_in_top_tables_go_to_the_lower_id(spark):
    weights = spark.createDataFrame([(0, 5, 1.0), (0, 2, 1.0), (0, 9, 0.5)], "concept INT, term_id BIGINT, weight DOUBLE")
    vocab = spark.createDataFrame([(2, "b"), (5, "e"), (9, "i")], "term_id BIGINT, term STRING")
    assert [r.term for r in top_terms(weights, vocab, 2).orderBy("rank").collect()] == ["b", "e"]
    docs = spark.createDataFrame([(0, 7, 1.0), (0, 3, 1.0)], "concept INT, doc_id BIGINT, weight DOUBLE")
    titles = spark.createDataFrame([(3, "x"), (7, "y")], "doc_id BIGINT, title STRING")
    assert [r.title for r in top_documents(docs, titles, 1).collect()] == ["x"]


def plain(spark, function, text):
    return spark.createDataFrame([(text,)], "t STRING").select(function(F.col("t")).alias("r")).first().r


def test_html_to_text(spark):
    html = '<!-- a <b> --><style>p{}</style><p>One &amp; <b>two</b>\n &lt;3&gt;<script>if (a<b) {}</script>&nbsp;end</p>'
    assert plain(spark, html_to_text, html) == "One & two <3> end"


def test_templates_go_at_any_depth(spark):
    nested = "{{a" * 5 + "}}" * 5
    assert plain(spark, wiki_to_text, f"one {nested} two {{{{x}}}} three {{{{ open") == "one two three {{ open"
    assert plain(spark, wiki_to_text, "none") == "none"


def test_wiki_to_text(spark):
    text = (
        "== Head ==\n'''Bold''' and ''it'' [[Target page|shown]] [[Plain]] [http://x.org site]<ref>no</ref>"
        "{{box|a={{inner|{{deep}}}}}} {| table |}[[File:a.png]] &quot;q&quot;"
    )
    assert plain(spark, wiki_to_text, text) == 'Head Bold and it shown Plain site "q"'


def test_article_pages(spark):
    schema = "title STRING, ns INT, redirect STRUCT<_title: STRING>, revision STRUCT<text: STRING>"
    rows = [
        ("Good", 0, None, ("'''Hi''' there",)),
        ("Empty", 0, None, ("  ",)),
        ("None", 0, None, None),
        ("Talk", 1, None, ("text",)),
        ("Moved", 0, ("Good",), ("text",)),
        ("Good (disambiguation)", 0, None, ("text",)),
    ]
    got = T.article_pages(spark.createDataFrame(rows, schema)).collect()
    assert [(r.title, r.content) for r in got] == [("Good", "Hi there")]


@pytest.mark.parametrize("method", ["table", "blocks"])
def test_rebuilt_cells(spark, method):
    """Rows that share a key add up, and V meets rows without a join."""
    rows, full = random_rows(spark, 40, 12)
    rows = checkpointed(rows.unionByName(rows) if method == "table" else rows)
    svd = truncated_svd(rows, 12, method=method)
    found = rebuilt(svd, method)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    cells = {(r.doc_id, r.term_id): r.value for r in found.collect()}
    assert len(cells) == full.size
    for (i, j), value in cells.items():
        assert value == pytest.approx(full[i, j] * (2 if method == "table" else 1), abs=1e-6)


def test_gramian_product_stays_in_its_task(spark):
    """A'A times a table without the rows' products between two Python steps."""
    rows, full = random_rows(spark, 60, 20)
    table = np.random.default_rng(1).standard_normal((20, 3))
    found = sparse_rows.gram_times(rows, table)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    expected = full.T @ full @ table
    for r in found.collect():
        np.testing.assert_allclose(np.frombuffer(r.vector), expected[r.term_id], atol=1e-8)
    np.testing.assert_allclose(np.abs(np.diag(sparse_rows.r_factor(rows, table=table))), np.abs(np.diag(np.linalg.qr(full @ table, mode="r"))), atol=1e-8)


def test_entries_per_key_make_the_rows(docs):
    """Entries are listed once and serve rows of documents, also where a key repeats."""
    tokens = T.document_tokens(docs.unionByName(docs.filter("doc_id = 2")))
    vocab = checkpointed(T.vocabulary(T.term_frequency(tokens), 6))
    listed = document_entries(tokens, vocab)
    assert listed.count() == listed.select("doc_id").distinct().count()
    one, other = rows_of_entries(tokens, listed), document_rows(tokens, vocab)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_columns_vectors_stay_in_their_tasks(spark, monkeypatch):
    """Of many columns only V is kept, not the vectors that the passes work with; rows go in several groups."""
    from tidemark.operators import concepts, row_groups

    kept = []

    def spy(frame, free=False):
        found = checkpointed(frame, free)
        if "vector" in found.columns:
            kept.append(sum(len(r.vector or b"") for r in found.select("vector").collect()))
        return found

    monkeypatch.setattr(concepts, "checkpointed", spy)
    monkeypatch.setattr(row_groups, "GROUP_ROWS", 16)
    monkeypatch.setattr(row_groups, "CACHE_BYTES", 4_000)
    rows, full = random_rows(spark, 90, 3000)
    svd = truncated_svd(checkpointed(rows), 3, method="blocks", terms=3000)
    np.testing.assert_allclose(svd.sigma, np.linalg.svd(full, compute_uv=False)[:3], rtol=1e-7)
    assert sum(kept) < 3000 * 32 * 8  # 32 vectors are what a pass over the columns took


def test_blocks_of_a_matrix_of_low_rank_and_of_zeros(spark):
    draw = np.random.default_rng(3)
    full = draw.standard_normal((50, 2)) @ draw.standard_normal((2, 500))
    rows = [(int(k), list(range(500)), [float(x) for x in r]) for k, r in enumerate(full)]
    frame = checkpointed(spark.createDataFrame(rows, "doc_id bigint, terms array<bigint>, weights array<double>"))
    svd = truncated_svd(frame, 5, method="blocks", terms=500)
    np.testing.assert_allclose(svd.sigma, np.linalg.svd(full, compute_uv=False)[:2], rtol=1e-9)
    none = truncated_svd(checkpointed(frame.withColumn("weights", F.transform("weights", lambda w: w * 0))), 5, method="blocks", terms=500)
    assert not len(none.sigma) and none.document_weights().count() == 0 == none.term_weights().count()


def test_many_passes_end_in_fewer_vectors(spark, monkeypatch):
    """Where the basis gets too wide only its best go on."""
    from tidemark.operators import concepts

    monkeypatch.setattr(concepts, "KEPT_BLOCKS", 2)
    rows, full = random_rows(spark, 300, 400, seed=4)
    svd = truncated_svd(checkpointed(rows), 6, method="blocks", terms=400)
    np.testing.assert_allclose(svd.sigma, np.linalg.svd(full, compute_uv=False)[:6], rtol=1e-6)


def test_report_writes_and_joins_no_vectors_of_documents(spark, docs, monkeypatch):
    """The sums of the report are made beside the rows; documents with equal ids meet each other, those without do not count."""
    import bindings.text as queries

    kept = []
    monkeypatch.setattr(queries, "checkpointed", lambda frame, *a: (kept.append(frame.columns), checkpointed(frame, *a))[1])
    model = fit_concepts(T.document_tokens(docs), 4, 6)
    found = queries._svd_report(model, 5).first()
    assert found.u_miss == found.v_miss == found.u_gap == found.v_gap == 0 and found.ordered and found.within
    assert not any("vector" in columns for columns in kept)
    checks = queries._svd_checks(model)._jdf.queryExecution().optimizedPlan().toString()
    assert all("_u#" not in line for line in checks.splitlines() if "Join" in line)

    twice = docs.unionByName(docs.orderBy("doc_id").limit(1)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")))
    model = fit_concepts(T.document_tokens(twice), 4, 6)
    rows = [r for r in model.rows.collect() if r.doc_id is not None]
    times = np.array([sum(r.doc_id == x.doc_id for x in rows) for r in rows])
    matrix = np.zeros((len(rows), 6))
    for r, row in zip(rows, matrix, strict=True):
        np.add.at(row, list(r.terms), list(r.weights))
    v = entries(model.svd.term_weights(), list(range(6)), "term_id")
    u = matrix @ v / model.svd.sigma
    got = {r.concept: r for r in queries._svd_checks(model).collect()}
    for c, sigma in enumerate(model.svd.sigma):
        assert got[c].u_length == pytest.approx(np.sqrt(times @ u[:, c] ** 2), abs=1e-6)
        gap = np.linalg.norm((matrix * times[:, None]).T @ u[:, c] - sigma * v[:, c]) / model.svd.sigma[0]
        assert got[c].v_gap == pytest.approx(gap, abs=1e-6) and got[c].u_gap == pytest.approx(0, abs=1e-9)


def test_blocks_of_rows_with_equal_keys(spark):
    """Rows of equal keys add up, and those without a key are left out."""
    rows, full = random_rows(spark, 40, 12)
    first = rows.filter("doc_id = 7")
    svd = truncated_svd(checkpointed(rows.unionByName(first).unionByName(first.withColumn("doc_id", F.lit(None).cast("bigint")))), 12, method="blocks")
    both = np.concatenate([full, full[7:8]])
    both[[7, 40]] *= 2
    np.testing.assert_allclose(svd.sigma, np.linalg.svd(both, compute_uv=False)[: len(svd.sigma)], rtol=1e-9)
    assert svd.documents.count() == 41 and svd.documents.filter("doc_id = 7").count() == 2
