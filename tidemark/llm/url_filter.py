"""URL filter: stated rules, and gradient-boosted trees on lexical features for the rest.

Features are column expressions: lengths, depth, digit share, entropy of the
characters, parameter counts, marks in the host, and statistics of the host's
last label (suffix) in the labelled sample.  Urls that a rule fits are the
labelled ones; trees learn from a bounded sample of them.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and is judged by the trees like any other; repeated rows are judged
each on their own; with no labelled urls, or one class of them only, that class
(allow without any) is the verdict of the rest; a column with the name of a
result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.blocks import make_room

#: Labelled urls that training reads at most, about; drawn by a hash of the url.
TRAINING_URLS = 20_000
ALLOW, BLOCK = "allow", "block"
#: (rule, verdict); fixed values of the query.
RULES = (
    ("org/", ALLOW),
    ("example.org/es/", BLOCK),
    ("example.org/en/1", BLOCK),
    ("com/fr/", ALLOW),
    ("com/de/", BLOCK),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = [
    "url_length",
    "host_length",
    "path_length",
    "host_depth",
    "path_depth",
    "host_digits",
    "path_digits",
    "host_dashes",
    "entropy",
    "parameters",
    "parameters_length",
    "has_fragment",
    "secure",
    "suffix_urls",
    "suffix_blocked",
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule whose host is the url's or a parent domain of it and whose path begins the url's."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits per character; characters are counted in their sorted order, as the lengths of runs."""
    runs = F.split(F.regexp_replace(F.array_join(F.array_sort(F.split(text, "")), ""), r"(?s)(.)(?!\1)", "$1\u0001"), "\u0001")
    sizes = F.filter(F.transform(runs, F.length), lambda n: n > 0)
    total = F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.aggregate(sizes, F.lit(0.0), lambda s, n: s - n / total * F.log2(n / total))


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` plus host, path, suffix and the lexical features (all but the suffix statistics)."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    out = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    return out.withColumns(
        {
            "suffix": F.substring_index("host", ".", -1),
            "url_length": F.length(text).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "host_depth": F.regexp_count("host", F.lit(r"\.")).cast("double"),
            "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
            "host_digits": _share(F.col("host"), "[0-9]"),
            "path_digits": _share(F.col("path"), "[0-9]"),
            "host_dashes": F.regexp_count("host", F.lit("-")).cast("double"),
            "entropy": _entropy(text),
            "parameters": F.when(query == "", 0.0).otherwise(F.regexp_count(query, F.lit("&")) + 1.0),
            "parameters_length": F.length(query).cast("double"),
            "has_fragment": text.contains("#").cast("double"),
            "secure": text.startswith("https://").cast("double"),
        }
    )


def judge(
    pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES, training: int = TRAINING_URLS, trees: int = 12, depth: int = 4
) -> DataFrame:
    """``pages`` plus host, path, rule, verdict and block_chance (of the trees; null where a rule decides).

    All steps are column expressions and Spark's own trees.  The labelled sample
    is bounded by ``training``, and so are its suffixes, which are broadcast.
    """
    pages = make_room(pages, "host", "path", "rule", "verdict", "block_chance")
    own = pages.columns
    held = [f"c{i}" for i in range(len(own))]
    rows = lexical(pages.toDF(*held), held[own.index(url)])
    verdict_of = dict(rules)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule)
    ruled = F.lit(None).cast("string")
    for text, verdict in verdict_of.items():
        ruled = F.when(F.col("rule") == text, verdict).otherwise(ruled)
    rows = rows.withColumn("ruled", ruled)
    labelled = rows.filter(F.col("rule").isNotNull()).withColumn("label", (F.col("ruled") == BLOCK).cast("double"))
    n = labelled.count()
    draw = F.pmod(F.xxhash64(held[own.index(url)]), F.lit(1_000_000)) < int(1_000_000 * min(1.0, training / max(n, 1)))
    features = FEATURES[:-2]
    sample = labelled.filter(draw).select("suffix", "label", *features).persist()
    try:
        classes = sample.agg(F.count("label").alias("n"), F.sum("label").alias("blocked")).first()
        blocked = classes.blocked or 0.0
        if 0 < blocked < classes.n:
            suffixes = sample.groupBy("suffix").agg(F.count("label").alias("urls"), F.sum("label").alias("bad"))
            prior = blocked / classes.n
            known = suffixes.select(
                "suffix",
                F.log1p(F.col("urls") * (100_000.0 / classes.n)).alias("suffix_urls"),
                ((F.col("bad") + 10 * prior) / (F.col("urls") + 10)).alias("suffix_blocked"),
            )
            known = pages.sparkSession.createDataFrame(known.collect(), known.schema)

            def complete(df: DataFrame) -> DataFrame:
                joined = df.join(F.broadcast(known), "suffix", "left")
                return joined.withColumns(
                    {"suffix_urls": F.coalesce("suffix_urls", F.lit(0.0)), "suffix_blocked": F.coalesce("suffix_blocked", F.lit(prior))}
                )

            vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
            boosted = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, seed=7, stepSize=0.3)
            model = boosted.fit(vector.transform(complete(sample)).select("features", "label"))
            judged = model.transform(vector.transform(complete(rows)))
            judged = judged.withColumn("block_chance", F.element_at(vector_to_array("probability"), 2))
        else:
            judged = rows.withColumn("block_chance", F.lit(1.0 if blocked else 0.0))
    finally:
        sample.unpersist()
    judged = judged.withColumn("block_chance", F.when(F.col("rule").isNull(), F.col("block_chance")))
    verdict = F.coalesce("ruled", F.when(F.col("block_chance") >= 0.5, BLOCK).otherwise(ALLOW))
    return judged.select(*held, "host", "path", "rule", verdict.alias("verdict"), "block_chance").toDF(
        *own, "host", "path", "rule", "verdict", "block_chance"
    )


def query(spark, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return judge(pages).drop("url")
