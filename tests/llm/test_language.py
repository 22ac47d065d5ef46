import zlib

from pyspark.sql import functions as F

from tidemark.llm import language

from .awkward import TEXTS, awkward, empty

EN = "the quick brown fox jumps over the lazy dog and then it runs away from the other animals of the wood "
DE = "der schnelle braune fuchs springt über den faulen hund und läuft dann weg von den anderen tieren des waldes "


def corpus(spark):
    rows = [(k, (EN if k % 2 else DE)[k % 40 :] * (1 + k % 3)) for k in range(60)]
    return awkward(spark, rows, lang=F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))


def test_held_out_documents_and_mixtures(spark):
    docs = corpus(spark)
    model = language.fit(docs.filter(~language.held_out()))
    assert model.languages == ["de", "en"]
    found = language.predict(docs.drop("lang"), model).filter(language.held_out()).collect()
    assert found and all(r.lang_pred == ("en" if r.doc_id % 2 else "de") and 0.9 < r.score <= 1 for r in found)
    mixed = awkward(spark, [(1, EN * 6 + DE * 2), (2, EN * 8)])
    rows = {r.doc_id: r.languages for r in language.predict(mixed, model).select("doc_id", "languages").collect()}
    assert set(rows[1]) == {"en", "de"} and 0.6 < rows[1]["en"] < 0.85
    assert rows[2] == {"en": 1.0}


def test_held_out_is_the_crc(spark):
    rows = awkward(spark).select("doc_id", language.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)


def test_awkward_rows(spark):
    model = language.fit(corpus(spark))
    rows = language.predict(awkward(spark), model).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text))


def test_nothing_to_learn_from(spark):
    model = language.fit(awkward(spark))
    assert model.languages == []
    rows = language.predict(awkward(spark), model).select("lang_pred", "score").collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert language.predict(empty(spark), language.fit(empty(spark))).count() == 0
