"""Text, TF-IDF and latent-concept queries on documents and pages."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.stopwords import STOP_WORDS
from tidemark.functions.vectors import to_vector
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
)
from tidemark.operators.sparse_rows import as_packed, column_squares, matrix_rows, small_batches, transposed_times
from tidemark.operators.lookups import exclude_terms
from tidemark.operators.partition_map import map_with_setup
from tidemark.operators.profiling import distinct_count
from tidemark.operators.terms import (
    apply_lemmas,
    article_pages,
    document_count,
    document_frequency,
    document_terms,
    document_tokens,
    explode_tokens,
    page_texts,
    term_frequency,
    tfidf,
    vocabulary,
)
from tidemark.operators.reshaping import term_map
from tidemark.plans.latent_concepts import fit_concepts
from tidemark.sources import (
    checkpointed,
    load_table,
    read_lines,
    read_numeric_csv,
    read_tagged_xml,
    read_word_list,
    scratch_path,
    spread_small_scan,
    write_lines,
    write_tagged_xml,
)

from .common import documents, embeddings, rounded

NUM_TERMS = 1500
GRAMIAN_TERMS = 1500
CONCEPTS = 20


def _tokens(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return document_tokens(documents(spark, folder, *columns), keep=columns)


def _tf(spark: SparkSession, folder: str) -> DataFrame:
    return term_frequency(_tokens(spark, folder))


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    return document_terms(_tokens(spark, folder))


def text_roundtrip(spark, folder):
    """Every document line written as text and read back, with its copies."""
    lines = documents(spark, folder).select(F.explode(F.split("text", "\n")).alias("value"))
    path = scratch_path(spark, "text")
    write_lines(lines, path)
    back = read_lines(spark, path)
    return back.groupBy(F.md5("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def numeric_csv_scan(spark, folder):
    """Order lines written as bare numbers and read back, totals in hundredths per line number."""
    names = ["linenumber", "quantity", "price", "discount", "tax"]
    columns = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    path = scratch_path(spark, "numbers")
    load_table(spark, folder, "lineitem").select(*columns).write.csv(path)
    back = read_numeric_csv(spark, path, names)
    return back.groupBy(F.col("linenumber").cast("int").alias("linenumber")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.round(F.col(c) * 100).cast("bigint")).alias(c) for c in names[1:]]
    )


def _page_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Page rows as dump pages: address as title, language as redirect or namespace.

    French pages become redirects, Spanish ones talk pages, and addresses with
    a query get a disambiguation title, so that every page filter has work.
    """
    language = F.regexp_extract("html", r'<html lang="([a-z]+)"', 1)
    marked = F.when(F.col("url").contains("?"), F.concat("url", F.lit(" (disambiguation)"))).otherwise(F.col("url"))
    pages = spread_small_scan(load_table(spark, folder, "pages"), "page_id")
    return pages.select(
        F.concat_ws(" ", F.col("page_id").cast("string"), marked).alias("title"),
        F.when(language == "es", 1).otherwise(0).alias("ns"),
        F.when(language == "fr", F.col("url")).alias("redirect"),
        "html",
    )


def _page_dump(spark: SparkSession, folder: str) -> str:
    redirect = F.when(F.col("redirect").isNotNull(), F.struct(F.col("redirect").alias("_title")))
    path = scratch_path(spark, "pages")
    write_tagged_xml(
        _page_titles(spark, folder).select(
            "title", "ns", redirect.alias("redirect"), F.struct(F.col("html").alias("text")).alias("revision")
        ),
        path,
    )
    return path


def tagged_xml_pages(spark, folder):
    pages = read_tagged_xml(spark, _page_dump(spark, folder))
    return pages.select(
        "title", "ns", F.col("redirect._title").alias("redirect"), F.md5("revision.text").alias("content")
    )


def xml_articles(spark, folder):
    """Articles of the dump in plain text."""
    articles = article_pages(read_tagged_xml(spark, _page_dump(spark, folder)))
    return articles.select("title", F.md5("content").alias("content"), F.length("content").alias("n_chars"))


def page_plain_text(spark, folder):
    pages = spread_small_scan(load_table(spark, folder, "pages").select("page_id", "html"), "page_id")
    texts = page_texts(pages)
    return texts.select("page_id", "title", F.md5("content").alias("content"), F.length("content").alias("n_chars"))


def tokens(spark, folder):
    """Per document: how many tokens, their letters, the first and the last."""
    rows = document_tokens(documents(spark, folder), stop_words=())
    letters = F.aggregate("tokens", F.lit(0), lambda total, t: total + F.length(t))
    return rows.select(
        "doc_id", F.size("tokens").alias("n"), letters.cast("bigint").alias("letters"),
        F.get("tokens", F.lit(0)).alias("first"), F.try_element_at("tokens", F.lit(-1)).alias("last"),
    )


def stopword_filter(spark, folder):
    """Token counts after a word list read from a file was excluded."""
    path = scratch_path(spark, "words")
    write_lines(spark.createDataFrame([(w,) for w in STOP_WORDS], "value STRING"), path)
    words = read_word_list(spark, path)
    rows = explode_tokens(document_tokens(documents(spark, folder), stop_words=()))
    kept = exclude_terms(rows, words, "term", max_rows=len(STOP_WORDS))
    return kept.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def kept_documents(spark, folder):
    return document_count(_tokens(spark, folder))


def term_counts(spark, folder):
    return _tf(spark, folder).select("doc_id", "doc_total", "term", "tf")


def doc_frequency(spark, folder):
    return document_frequency(_terms(spark, folder))


def distinct_terms(spark, folder):
    return distinct_count(_terms(spark, folder), "term")


def term_maps(spark, folder):
    """Facts about the per-document maps."""
    maps = term_map(_tf(spark, folder))
    return maps.select(
        "doc_id", F.size(F.map_keys("terms")).alias("terms"),
        F.aggregate(F.map_values("terms"), F.lit(0).cast("bigint"), lambda total, n: total + n).alias("tokens"),
    )


def _plural_lemmas(counts: DataFrame) -> DataFrame:
    """(term, lemma): words in -s whose form without it also occurs."""
    seen = counts.select("term")
    stems = seen.filter(F.col("term").endswith("s")).select("term", F.expr("left(term, length(term) - 1)").alias("lemma"))
    return stems.join(seen.select(F.col("term").alias("lemma")), "lemma", "left_semi").select("term", "lemma")


def lemma_counts(spark, folder):
    """Document frequencies after plurals were merged with their stems."""
    tf = _tf(spark, folder)
    merged = apply_lemmas(tf, checkpointed(_plural_lemmas(checkpointed(document_frequency(_terms(spark, folder))))))
    return merged.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))


def setup_map(spark, folder):
    """Texts in composed Unicode form, which no built-in function makes; the form is set up once per task."""

    def setup():
        form = "NFC"
        return lambda batch: batch.assign(text=batch["text"].str.normalize(form))

    composed = map_with_setup(documents(spark, folder), setup, "doc_id BIGINT, text STRING")
    return composed.select("doc_id", F.md5("text").alias("composed"))


def vocab_top_n(spark, folder):
    return vocabulary(_terms(spark, folder), NUM_TERMS).select("term_id", "term", "df")


def full_vocabulary(spark, folder):
    return vocabulary(_terms(spark, folder)).select("term_id", "term", "df")


def idf(spark, folder):
    return rounded(vocabulary(_terms(spark, folder), NUM_TERMS).select("term", "idf"), "idf")


def tfidf_top(spark, folder):
    weights = tfidf(_tf(spark, folder), vocabulary(_terms(spark, folder), NUM_TERMS), max_terms=NUM_TERMS)
    return rounded(weights.select("doc_id", "term", "weight"), "weight")


def tfidf_full(spark, folder):
    """Weights over the whole vocabulary, totalled per document."""
    weights = tfidf(_tf(spark, folder), vocabulary(_terms(spark, folder)))
    totals = weights.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.sum("weight").alias("weight"))
    return rounded(totals, "weight")


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    rows = embeddings(spark, folder).select("vec_id", to_vector(F.col("values")).alias("weights"))
    return checkpointed(matrix_rows(rows, "vec_id", "weights"))


def svd_energy(spark, folder):
    """The squares of all singular values add up to those of all entries."""
    values = truncated_svd(_vectors(spark, folder), 64, "vec_id").singular_values(spark)
    return rounded(values.agg(F.sum(F.col("sigma") * F.col("sigma")).alias("energy")), "energy", places=4)


def svd_rebuild(spark, folder):
    """A'A put together again from all singular values and V."""
    svd = truncated_svd(_vectors(spark, folder), 64, "vec_id")
    v, sigma = svd.term_weights(), svd.singular_values(spark)
    left = v.join(sigma, "concept").select("concept", F.col("term_id").alias("i"), (F.col("weight") * F.pow("sigma", F.lit(2))).alias("_left"))
    cells = left.join(v.select("concept", F.col("term_id").alias("j"), "weight"), "concept").filter("i <= j")
    return rounded(cells.groupBy("i", "j").agg(F.sum(F.col("_left") * F.col("weight")).alias("value")), "value", places=4)


def svd_rebuild_rows(spark, folder, method="auto"):
    """The vectors put together again from U, the singular values and V."""
    svd = truncated_svd(_vectors(spark, folder), 64, "vec_id", method=method)
    return rounded(rebuilt(svd, method), "value", places=4)


def svd_rebuild_blocks(spark, folder):
    """The same, where V is never a table."""
    return svd_rebuild_rows(spark, folder, "blocks")


def svd_methods(spark, folder):
    """Largest difference between the two ways to the same singular values."""
    rows = _vectors(spark, folder)
    one = truncated_svd(rows, 5, "vec_id").singular_values(spark)
    other = truncated_svd(rows, 5, "vec_id", method="blocks").singular_values(spark).withColumnRenamed("sigma", "_other")
    gap = F.max(F.abs(F.col("sigma") - F.col("_other")))
    return one.join(other, "concept").agg(F.count(F.lit(1)).alias("n"), (gap < 1e-6).alias("same"))


def term_gramian(spark, folder):
    """Sums over documents of weight products, for each pair of terms."""
    docs = _tokens(spark, folder)
    vocab = vocabulary(document_terms(docs), GRAMIAN_TERMS)
    return rounded(gramian_entries(document_rows(docs, vocab, max_terms=GRAMIAN_TERMS), vocab.count()), "value")


def matrix_entries(spark, folder):
    """The document rows over the whole vocabulary: terms, total weight and first term of each."""
    docs = _tokens(spark, folder)
    rows = document_rows(docs, vocabulary(document_terms(docs)))
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    found = rows.select("doc_id", F.size("terms").cast("bigint").alias("terms"), F.get("terms", F.lit(0)).alias("first"), total.alias("weight"))
    return rounded(found, "weight")


def lsa_energy(spark, folder):
    """Energy of all concepts of the document-term matrix."""
    values = fit_concepts(_tokens(spark, folder), NUM_TERMS, NUM_TERMS).singular_values()
    return rounded(values.agg(F.sum(F.col("sigma") * F.col("sigma")).alias("energy")), "energy", places=4)


def lsa_singular_values(spark, folder):
    return fit_concepts(_tokens(spark, folder), CONCEPTS, NUM_TERMS).singular_values()


def lsa_sigma_order(spark, folder):
    """How many singular values there are, and whether each is positive and none larger than the one before."""
    values = fit_concepts(_tokens(spark, folder), CONCEPTS, NUM_TERMS).singular_values()
    return values.agg(F.count("sigma").alias("n"), _ordered(values).alias("ordered"))


def _ordered(values: DataFrame):
    """Whether each value is positive and none larger than the one before; for (concept, sigma) rows."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("concept", "sigma"))), lambda x: x["sigma"])
    return F.forall(listed, lambda x: x > 0) & (listed == F.reverse(F.array_sort(listed)))


def lsa_top_terms(spark, folder):
    return fit_concepts(_tokens(spark, folder), CONCEPTS, NUM_TERMS).top_terms(10)


def lsa_top_docs(spark, folder):
    docs = _tokens(spark, folder, "source")
    return fit_concepts(docs, CONCEPTS, NUM_TERMS).top_documents(docs, 10, "source")


def lsa_shape(spark, folder):
    """Per concept: length of its document column, and its ranked documents."""
    weights = fit_concepts(_tokens(spark, folder), CONCEPTS, NUM_TERMS).svd.document_weights()
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    return weights.groupBy("concept").agg(F.round(length, 6).alias("length"), F.count("doc_id").alias("documents"))


def lsa_term_weights(spark, folder):
    """Per concept: length of its term column, and how many terms it has."""
    weights = fit_concepts(_tokens(spark, folder), CONCEPTS, NUM_TERMS).svd.term_weights()
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    return weights.groupBy("concept").agg(F.round(length, 6).alias("length"), F.count("term_id").alias("terms"))


def _svd_checks(model, key: str = "doc_id") -> DataFrame:
    """Per concept: lengths of u and v, and of A'u - sigma v and A v - sigma u in parts of the largest value.

    Rows of equal keys meet each other: each counts as often as its key, and rows without a key do not.
    """
    svd, spark = model.svd, model.rows.sparkSession
    small_batches(spark)
    number = model.rows.groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    rows = svd.beside(model.rows.join(number, key)).withColumnRenamed("vector", "_u")
    weights = F.transform("weights", lambda w: w * F.col("_times"))
    back = transposed_times(rows.select("terms", weights.alias("weights"), F.col("_u").alias("vector"))).select("term_id", F.col("vector").alias("_back"))
    there = project(rows, svd.terms, svd.sigma, key, keep=("_u", "_times"))
    values = spark.createDataFrame([(i, float(s), float(s / svd.sigma[0])) for i, s in enumerate(svd.sigma)], "concept INT, sigma DOUBLE, share DOUBLE")
    v = column_squares(svd.terms.join(back, "term_id"), "_back", "vector", svd.sigma).toDF("concept", "v", "v_gap")
    u = column_squares(there, "vector", "_u", np.ones(len(svd.sigma)), "_times").toDF("concept", "u", "u_gap")
    both = values.join(v, "concept").join(u, "concept")
    return both.select(
        "concept",
        "sigma",
        F.round(F.sqrt("u"), 6).alias("u_length"),
        F.round(F.sqrt("v"), 6).alias("v_length"),
        (F.sqrt("v_gap") / F.col("sigma") * F.col("share")).alias("v_gap"),
        (F.sqrt("u_gap") * F.col("share")).alias("u_gap"),
    )


def _svd_report(model, places: int) -> DataFrame:
    """One row: how many concepts, whether in order, largest misses; the energy that is left beside the matrix's own."""
    checks = checkpointed(_svd_checks(model))
    whole = model.rows.agg(F.sum(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x * x)).alias("energy"))
    found = checks.agg(
        F.count("concept").alias("n"),
        _ordered(checks).alias("ordered"),
        F.round(F.max(F.abs(F.col("u_length") - 1)), places).alias("u_miss"),
        F.round(F.max(F.abs(F.col("v_length") - 1)), places).alias("v_miss"),
        F.round(F.max("u_gap"), places).alias("u_gap"),
        F.round(F.max("v_gap"), places).alias("v_gap"),
        (F.sum(F.col("sigma") * F.col("sigma"))).alias("_energy"),
    )
    return found.join(whole).select("n", "ordered", "u_miss", "v_miss", "u_gap", "v_gap", (F.col("_energy") <= F.col("energy") * (1 + 1e-9)).alias("within"), F.round("energy", 4).alias("energy"))


def svd_1000(spark, folder):
    """Up to 1000 concepts of 1500 terms: the triples satisfy A v = sigma u and A'u = sigma v."""
    return _svd_report(fit_concepts(_tokens(spark, folder), 1000, NUM_TERMS), 5).drop("n")  # the rank, if below 1000


def svd_full(spark, folder):
    """Concepts of the whole vocabulary, with V in blocks and never a table."""
    return _svd_report(fit_concepts(_tokens(spark, folder), CONCEPTS, None, method="blocks", passes=12, tolerance=1e-6), 2)


LANGUAGES = ["de", "en", "es", "fr"]


def _language_concepts(spark: SparkSession, folder: str):
    """A given V: one concept per language, its mean weight per term; and the entries of each document, kept.

    A document's language meets its entries as one row.
    """
    docs = _tokens(spark, folder, "lang")
    vocab = checkpointed(vocabulary(document_terms(docs), NUM_TERMS))
    listed = checkpointed(document_entries(docs, vocab, max_terms=NUM_TERMS))
    languages = load_table(spark, folder, "documents").select("doc_id", "lang")
    concept = F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang")) - 1
    weights = listed.join(languages, "doc_id").select(concept.cast("int").alias("concept"), F.explode("_e").alias("_e"))
    sums = weights.groupBy("concept", F.col("_e.term_id").alias("term_id")).agg(F.sum("_e.weight").alias("weight"))
    return docs, vocab, listed, sums.filter("concept >= 0")


def given_top_terms(spark, folder):
    """The ten heaviest terms of each language."""
    _, vocab, _, v = _language_concepts(spark, folder)
    return rounded(top_terms(v, vocab, 10), "weight", places=5)


def given_top_docs(spark, folder, method="auto"):
    """The ten documents that weigh most in each language's direction."""
    docs, _, listed, sums = _language_concepts(spark, folder)
    weight = [F.sum(F.when(F.col("concept") == c, F.col("weight")).otherwise(0.0)) for c in range(len(LANGUAGES))]
    terms = checkpointed(sums.groupBy("term_id").agg(F.array(*weight).alias("w")).select("term_id", "w", as_packed("w").alias("vector")))
    sigma = terms.select(*[F.sqrt(F.sum(F.pow(F.col("w")[c], F.lit(2)))) for c in range(len(LANGUAGES))]).first()
    rows = rows_of_entries(load_table(spark, folder, "documents").select("doc_id"), listed)
    weights = heaviest_documents(project(rows, terms.drop("w"), list(sigma), method=method), 10)
    best = top_documents(weights, docs, 10, title="lang")
    return rounded(best.select("concept", "rank", "weight"), "weight", places=5)


def given_top_docs_blocks(spark, folder):
    """The same, with V joined by blocks of terms."""
    return given_top_docs(spark, folder, "blocks")


QUERIES = {
    "text_roundtrip": text_roundtrip,
    "numeric_csv_scan": numeric_csv_scan,
    "tagged_xml_pages": tagged_xml_pages,
    "xml_articles": xml_articles,
    "page_plain_text": page_plain_text,
    "tokens": tokens,
    "stopword_filter": stopword_filter,
    "kept_documents": kept_documents,
    "term_frequency": term_counts,
    "document_frequency": doc_frequency,
    "distinct_terms": distinct_terms,
    "term_maps": term_maps,
    "lemma_counts": lemma_counts,
    "setup_map": setup_map,
    "vocab_top_n": vocab_top_n,
    "full_vocabulary": full_vocabulary,
    "idf": idf,
    "tfidf": tfidf_top,
    "tfidf_full": tfidf_full,
    "svd_energy": svd_energy,
    "svd_methods": svd_methods,
    "svd_rebuild": svd_rebuild,
    "svd_rebuild_rows": svd_rebuild_rows,
    "svd_rebuild_blocks": svd_rebuild_blocks,
    "matrix_entries": matrix_entries,
    "term_gramian": term_gramian,
    "lsa_energy": lsa_energy,
    "lsa_singular_values": lsa_singular_values,
    "lsa_sigma_order": lsa_sigma_order,
    "lsa_top_terms": lsa_top_terms,
    "lsa_top_docs": lsa_top_docs,
    "lsa_shape": lsa_shape,
    "lsa_term_weights": lsa_term_weights,
    "svd_1000": svd_1000,
    "svd_full": svd_full,
    "given_top_terms": given_top_terms,
    "given_top_docs": given_top_docs,
    "given_top_docs_blocks": given_top_docs_blocks,
}

_WORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
_LIST = (
    r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}'']+'), "
    r"lambda w: regexp_full_match(w, '\p{L}{3,}'))"
)
_ALL_TOKENS = f"all_tokens AS (SELECT doc_id, {_LIST} AS t FROM documents)"
_TF = f"""{_ALL_TOKENS},
kept AS (SELECT doc_id, list_filter(t, lambda w: w NOT IN ({_WORDS})) AS t FROM all_tokens),
tf AS (
  SELECT doc_id, doc_total, term, count(*) AS tf
  FROM (SELECT doc_id, len(t) AS doc_total, unnest(t) AS term FROM kept WHERE len(t) > 1) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
numbered AS (SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id,
                    ln((SELECT count(*) FROM kept WHERE len(t) > 1) / df) AS idf FROM df)"""
_WEIGHTS = _TF + """,
w AS (SELECT doc_id, term, term_id, idf * tf / doc_total AS weight FROM tf JOIN numbered USING (term) WHERE term_id < :n)"""


def _weights_sql(terms: int) -> str:
    return _WEIGHTS.replace(":n", str(terms))


_TOP = _weights_sql(NUM_TERMS)
_BLOCKS = [r"(?s)<!--.*?-->", r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?is)<ref\b[^>]*/>",
           r"(?is)<ref\b.*?</ref>"]


def _sql_replace(text: str, pattern: str, into: str) -> str:
    return "regexp_replace({}, '{}', '{}', 'g')".format(text, pattern.replace("'", "''"), into)


def _sql_unescape(text: str) -> str:
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def _sql_plain(text: str, wiki: bool = False) -> str:
    for block in _BLOCKS:
        text = _sql_replace(text, block, " ")
    if wiki:
        for _ in range(3):
            text = _sql_replace(text, r"\{\{[^{}]*\}\}", " ")
        text = _sql_replace(text, r"(?s)\{\|.*?\|\}", " ")
        text = _sql_replace(text, r"\[\[(?:File|Image|Category):[^\[\]]*\]\]", " ")
        text = _sql_replace(text, r"\[\[(?:[^|\[\]]*\|)?([^|\[\]]*)\]\]", r"\1")
        text = _sql_replace(text, r"\[[a-z]+://[^\s\]]+ ?([^\]]*)\]", r"\1")
        text = _sql_replace(text, r"(?m)^=+([^=\n]*)=+[ \t]*$", r"\1")
        text = _sql_replace(text, r"'{2,}", "")
    text = _sql_unescape(_sql_replace(text, r"(?s)<[^<>]*>", " "))
    return f"trim({_sql_replace(text, '[ ' + chr(92) + 't' + chr(92) + 'r' + chr(92) + 'n' + chr(92) + 'f]+', ' ')})"


_TITLES = """dump AS (
  SELECT CAST(page_id AS VARCHAR) || ' ' || CASE WHEN contains(url, '?') THEN url || ' (disambiguation)' ELSE url END AS title,
         CASE WHEN lang = 'es' THEN 1 ELSE 0 END AS ns, CASE WHEN lang = 'fr' THEN url END AS redirect, html
  FROM (SELECT *, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages))"""
_ARTICLES = f"SELECT title, {_sql_plain('html', wiki=True)} AS content FROM dump " \
            "WHERE ns = 0 AND redirect IS NULL AND NOT contains(title, '(disambiguation)') AND length(trim(html)) > 0"
_LANG_V = _TOP + """,
lw AS (SELECT doc_id, term_id, term, weight, CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END AS concept
       FROM w JOIN documents USING (doc_id)),
v AS (SELECT concept, term_id, term, sum(weight) AS weight FROM lw WHERE concept IS NOT NULL GROUP BY ALL)"""

ORACLE = {
    "text_roundtrip": "SELECT md5(line) AS line, count(*) AS n FROM "
    "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1",
    "numeric_csv_scan": "SELECT l_linenumber AS linenumber, count(*) AS n, "
    + ", ".join(
        f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS BIGINT) AS {n}"
        for c, n in [("l_quantity", "quantity"), ("l_extendedprice", "price"), ("l_discount", "discount"), ("l_tax", "tax")]
    )
    + " FROM lineitem GROUP BY l_linenumber",
    "tagged_xml_pages": f"WITH {_TITLES} SELECT title, ns, redirect, md5(html) AS content FROM dump",
    "xml_articles": f"WITH {_TITLES}, a AS ({_ARTICLES}) SELECT title, md5(content) AS content, "
    "CAST(length(content) AS INTEGER) AS n_chars FROM a",
    "page_plain_text": "WITH p AS (SELECT page_id, "
    + _sql_plain("regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1)")
    + f" AS title, {_sql_plain('html')} AS content FROM pages) "
    "SELECT page_id, title, md5(content) AS content, CAST(length(content) AS INTEGER) AS n_chars FROM p",
    "tokens": f"WITH {_ALL_TOKENS} SELECT doc_id, CAST(len(t) AS INTEGER) AS n, "
    "CAST(coalesce(list_sum(list_transform(t, lambda w: length(w))), 0) AS BIGINT) AS letters, "
    "t[1] AS first, t[len(t)] AS last FROM all_tokens",
    "stopword_filter": f"WITH {_ALL_TOKENS} SELECT term, count(*) AS n FROM (SELECT unnest(t) AS term FROM all_tokens) "
    f"WHERE term NOT IN ({_WORDS}) GROUP BY term",
    "kept_documents": f"WITH {_TF} SELECT count(*) AS n FROM kept WHERE len(t) > 1",
    "term_frequency": f"WITH {_TF} SELECT doc_id, CAST(doc_total AS BIGINT) AS doc_total, term, tf FROM tf",
    "document_frequency": f"WITH {_TF} SELECT term, df FROM df",
    "distinct_terms": f"WITH {_TF} SELECT count(*) AS n FROM df",
    "term_maps": f"WITH {_TF} SELECT doc_id, CAST(count(*) AS INTEGER) AS terms, CAST(sum(tf) AS BIGINT) AS tokens "
    "FROM tf GROUP BY doc_id",
    "lemma_counts": f"WITH {_TF}, lemmas AS (SELECT term, left(term, length(term) - 1) AS lemma FROM df "
    "WHERE term LIKE '%s' AND left(term, length(term) - 1) IN (SELECT term FROM df)), "
    "merged AS (SELECT doc_id, coalesce(lemma, term) AS term, sum(tf) AS tf FROM tf LEFT JOIN lemmas USING (term) GROUP BY ALL) "
    "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM merged GROUP BY term",
    "setup_map": "SELECT doc_id, md5(nfc_normalize(text)) AS composed FROM documents",
    "vocab_top_n": f"WITH {_TF} SELECT term_id, term, df FROM numbered WHERE term_id < {NUM_TERMS}",
    "full_vocabulary": f"WITH {_TF} SELECT term_id, term, df FROM numbered",
    "idf": f"WITH {_TF} SELECT term, round(idf, 6) AS idf FROM numbered WHERE term_id < {NUM_TERMS}",
    "tfidf": f"WITH {_TOP} SELECT doc_id, term, round(weight, 6) AS weight FROM w",
    "tfidf_full": f"WITH {_weights_sql(10**12)} SELECT doc_id, count(*) AS terms, round(sum(weight), 6) AS weight "
    "FROM w GROUP BY doc_id",
    "svd_energy": "SELECT round(sum(v * v), 4) AS energy FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)",
    "svd_rebuild": "WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, "
    "CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS d FROM embeddings) SELECT a.d AS i, b.d AS j, "
    "round(sum(a.v * b.v), 4) AS value FROM e a JOIN e b USING (vec_id) WHERE a.d <= b.d GROUP BY a.d, b.d",
    "svd_rebuild_rows": "SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS term_id, "
    "round(CAST(unnest(embedding) AS DOUBLE), 4) AS value FROM embeddings",
    "svd_methods": "SELECT count(*) AS n, true AS same FROM (SELECT label FROM embeddings GROUP BY label "
    "ORDER BY label LIMIT 5)",
    "term_gramian": f"WITH {_weights_sql(GRAMIAN_TERMS)}, "
    "sums AS (SELECT a.term_id AS i, b.term_id AS j, sum(a.weight * b.weight) AS value FROM w a JOIN w b USING (doc_id) "
    "WHERE a.term_id <= b.term_id GROUP BY ALL), "
    f"ids AS (SELECT term_id FROM numbered WHERE term_id < {GRAMIAN_TERMS}) "
    "SELECT CAST(a.term_id AS INTEGER) AS i, CAST(b.term_id AS INTEGER) AS j, round(coalesce(value, 0), 6) AS value "
    "FROM ids a JOIN ids b ON a.term_id <= b.term_id LEFT JOIN sums ON i = a.term_id AND j = b.term_id",
    "lsa_sigma_order": f"WITH {_TOP} SELECT least({CONCEPTS}, count(DISTINCT term_id)) AS n, true AS ordered FROM w",
    "lsa_energy": f"WITH {_TOP} SELECT round(sum(weight * weight), 4) AS energy FROM w",
    "lsa_shape": f"WITH {_TOP} SELECT CAST(c AS INTEGER) AS concept, CAST(1 AS DOUBLE) AS length, "
    f"(SELECT count(*) FROM documents) AS documents FROM range({CONCEPTS}) r(c)",
    "lsa_term_weights": f"WITH {_TOP} SELECT CAST(c AS INTEGER) AS concept, CAST(1 AS DOUBLE) AS length, "
    f"(SELECT count(DISTINCT term_id) FROM w) AS terms FROM range({CONCEPTS}) r(c)",
    "given_top_terms": f"WITH {_LANG_V}, ranked AS (SELECT *, row_number() OVER (PARTITION BY concept ORDER BY weight DESC, term_id) "
    "AS rank FROM v) SELECT concept, CAST(rank AS INTEGER) AS rank, term, round(weight, 5) AS weight FROM ranked WHERE rank <= 10",
    "given_top_docs": f"WITH {_LANG_V}, s AS (SELECT concept, sqrt(sum(weight * weight)) AS sigma FROM v GROUP BY concept), "
    "u AS (SELECT w.doc_id, v.concept, sum(w.weight * v.weight) / any_value(sigma) AS weight FROM w JOIN v USING (term_id) "
    "JOIN s USING (concept) GROUP BY w.doc_id, v.concept), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY concept ORDER BY weight DESC, doc_id) AS rank FROM u) "
    "SELECT concept, CAST(rank AS INTEGER) AS rank, round(weight, 5) AS weight FROM ranked WHERE rank <= 10",
}
ORACLE["svd_rebuild_blocks"] = ORACLE["svd_rebuild_rows"]
ORACLE["given_top_docs_blocks"] = ORACLE["given_top_docs"]
ORACLE["matrix_entries"] = (
    f"WITH {_weights_sql(10**12)} SELECT d.doc_id, count(w.term_id) AS terms, min(w.term_id) AS first, "
    "round(coalesce(sum(weight), 0), 6) AS weight FROM documents d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id"
)
_REPORT = "true AS ordered, 0.0::DOUBLE AS u_miss, 0.0::DOUBLE AS v_miss, 0.0::DOUBLE AS u_gap, 0.0::DOUBLE AS v_gap, true AS within"
ORACLE["svd_1000"] = f"WITH {_TOP} SELECT {_REPORT}, round(sum(weight * weight), 4) AS energy FROM w"
ORACLE["svd_full"] = f"WITH {_weights_sql(10**12)} SELECT CAST({CONCEPTS} AS BIGINT) AS n, {_REPORT}, round(sum(weight * weight), 4) AS energy FROM w"
