"""Tables of odd rows that every operator has to take."""

from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()
LONG = " ".join(f"{WORDS[k % 15]}{k % 97}" for k in range(20_000))
TEXTS = [
    (None, "a text without an id"),
    (1, None),
    (2, ""),
    (3, "### !! ..."),
    (4, "word"),
    (5, "the same row again and again and again"),
    (5, "the same row again and again and again"),
    (5, "another text of the same id"),
    (6, "ÀÉ ñandú über straße 中文 текст"),
    (7, LONG),
    (8, "line one is here\nline two is here\n\nline one is here\n"),
    (9, "Line One is HERE, line two is here"),
]
#: Names that operators use inside, or return.
CLASH = ("key", "row", "node", "raw", "n", "part", "rank", "label", "tokens", "text_key", "__row", "c0", "c1", "class", "lang_pred")


def awkward(spark, rows=TEXTS, **columns):
    frame = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    frame = frame.withColumns({c: F.lit(k) for k, c in enumerate(CLASH)})
    defaults = {"lang": F.lit(None).cast("string"), "source": F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise("web")}
    return frame.withColumns({**defaults, **columns}).repartition(3)


def empty(spark):
    return awkward(spark).limit(0)
