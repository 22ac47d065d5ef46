import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tidemark.llm import decontaminate, language, mixing, near_copies
from tidemark.llm.blocks import BATCH_BYTES

from .test_decontaminate import brute

EN = "the quick brown fox jumps over the lazy dog and runs away from other animals of the dark old wood near town".split()
DE = "der schnelle braune fuchs springt über den faulen hund und läuft weg von anderen tieren des dunklen waldes".split()


def text_of(k):
    words = EN if k % 2 else DE
    return " ".join(words[(k * 7 + j * (1 + k % 5)) % len(words)] + ("" if j % 9 else f" n{k}x{j}") for j in range(60))


ITEM = " ".join(f"secret{j}" for j in range(15))
ROWS = [(k, text_of(k)) for k in range(40)]
EXTRA = [
    (100, ROWS[3][1]),  # exact copy
    (101, ROWS[4][1] + " end"),  # near copy
    (102, None), (103, ""), (104, "12345 !!! ###"),  # no language
    (105, "the dog " + ITEM + " ran away from the wood"),  # contaminated
    (106, text_of(41) + " write to ann.lee@mail.org or ann.lee@mail.org, card 4111111111111111"),
    (107, " ".join(text_of(k) for k in range(200, 215)) + " " + ITEM),  # hit, but below the limit
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame(ROWS + EXTRA, "doc_id bigint, text string")
    lang = F.when(F.col("doc_id") < 100, F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))
    docs = docs.withColumns({"lang": lang, "source": F.concat(F.lit("s"), F.col("doc_id") % 3), "n_chars": F.length("text").cast("bigint"), "key": F.lit(1)})
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([("i", ITEM)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_every_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    gone = [{102, 103, 104}, {100, 101}, {105}, set()]
    for (name, stage), out in zip(cp.STAGES[:-1], gone, strict=True):
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        assert ids(before) - ids(docs) == out and ids(docs) <= ids(before)
    texts = {r.doc_id: r for r in docs.collect()}
    for i, t in ROWS:
        assert texts[i].text == t
    # the benchmark's window is cut, the rest stays
    assert ITEM not in texts[107].text and texts[107].text.strip() == EXTRA[-1][1].removesuffix(ITEM).strip()
    assert texts[107].n_chars == len(texts[107].text)
    n, hit, _ = brute(EXTRA[-1][1], [("i", ITEM)])
    assert 0 < 20 * hit < n and brute(texts[107].text, [("i", ITEM)])[1] == 0
    new = texts[106]
    assert "ann.lee" not in new.text and "4111" not in new.text and new.n_chars == len(new.text)
    assert len(set(re.findall(r"\S+@[\w.]+\w", new.text))) == 1
    name, last = cp.STAGES[-1]
    mixed = last(spark, docs, folder)
    assert {tuple(r) for r in mixed.collect()} == {tuple(r) for r in mixing.mix(docs).collect()}
    assert ids(mixed) <= ids(docs)


def test_run(spark, folder):
    out = cp.run(spark, folder)
    assert {"doc_id", "text", "source", "n_tokens", "epoch", "order_key"} <= set(out.columns)
    assert not ids(out) & {100, 101, 102, 103, 104, 105} and len(ids(out)) > 30


def test_stages_take_empty_tables(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0


def test_stages_keep_columns_of_any_name(spark, folder):
    """A caller's columns that have the names of results come out as they were."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["score", "languages", "lang_pred", "n_words", "n_hit", "hit_items", "hit_spans", "n_mentions", "row", "class", "class_id", "node", "label"]
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in names)


def batch_sizes(frame):
    """(rows, bytes) of the Arrow batches in which tasks get the rows of ``frame``."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    return [tuple(r) for r in frame.mapInArrow(sizes, "rows bigint, bytes bigint").collect()]


@pytest.fixture
def no_limit(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    spark.conf.unset(limit)
    yield limit
    if before is None:
        spark.conf.unset(limit)
    else:
        spark.conf.set(limit, before)


def wide(spark, rows=300, times=100):
    """Different texts of about 40 KB in one partition."""
    docs = spark.createDataFrame([(k, f"n{k} {text_of(k)} ") for k in range(rows)], "doc_id bigint, text string").coalesce(1)
    return docs.withColumns({"text": F.repeat("text", F.lit(times)), "lang": F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de")})


@pytest.mark.parametrize("stage", [cp.identify_language, cp.drop_near_copies, cp.drop_contaminated])
def test_batches_of_texts_are_small(spark, folder, no_limit, stage):
    """By Spark's own limit all rows would be one batch, or two."""
    docs = wide(spark)
    assert max(b for _, b in batch_sizes(docs)) > 3 * BATCH_BYTES
    stage(spark, docs.limit(20), folder)
    longest = 1 << 17
    sizes = batch_sizes(docs)
    assert sum(n for n, _ in sizes) == 300 and max(b for _, b in sizes) <= BATCH_BYTES + longest


@pytest.mark.parametrize("query", [language.query, decontaminate.query, near_copies.query])
def test_queries_of_the_same_operators_have_small_batches(spark, folder, no_limit, query):
    query(spark, folder)
    assert max(b for _, b in batch_sizes(wide(spark))) <= BATCH_BYTES + (1 << 17)


def test_a_limit_of_the_session_stays(spark, folder, no_limit):
    spark.conf.set(no_limit, "32m")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert ids(cp.identify_language(spark, docs, folder)) == ids(docs) - {102, 103, 104}
    assert spark.conf.get(no_limit) == "32m"


def test_batches_change_no_result(spark, folder, no_limit):
    docs = spark.read.parquet(f"{folder}/documents.parquet").coalesce(1)
    found = []
    for limit in ("64m", "1"):  # one batch, and one for each row
        spark.conf.set(no_limit, limit)
        rows = [decontaminate.query(spark, folder), language.query(spark, folder), near_copies.query(spark, folder)]
        rows += [stage(spark, docs, folder) for stage in (cp.identify_language, cp.drop_near_copies, cp.drop_contaminated)]
        found.append([sorted(map(str, r.collect())) for r in rows])
    assert found[0] == found[1]
