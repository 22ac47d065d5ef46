"""Replacing personal data and secrets by keyed surrogates.

Mentions are found by one pattern.  Each distinct value gets a surrogate from a
keyed hash that keeps its type and form: digits for digits and letters for
letters in the same places, names by gender (of the title), part (given or
family name), script and case.  Equal values get equal surrogates everywhere, so
coreference survives: a family name is the same with and without a given name.
Distinct values get distinct ones: values whose surrogates clash, or equal a
value that the texts contain, are hashed anew until none do.

Everything is column expressions; only mentions are shuffled, and the texts that
have some.

Defined cases: a null text stays null, an empty one empty, with 0 mentions;
repeated rows are all replaced alike; an empty table stays empty; a column with the
name of a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.blocks import make_room
from tidemark.sources.scratch import checkpointed

MALE = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Doña", "Госпожа", "Κυρία")
_TITLES = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
_NAME = r"\p{Lu}[\p{L}'’-]+"
NAME = rf"(?<![\p{{L}}\d])(?:{_TITLES})\.? {_NAME}(?: {_NAME})?"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
PHONE = r"(?<![\p{L}\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\) ?\d{3}[ .-]\d{4})(?![\p{L}\d])"
NATIONAL = r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d-])"
CARD = r"(?<![\p{L}\d])\d(?:[ -]?\d){12,18}(?![\p{L}\d])"
SECRET = r"(?<=[\"'])(?=[_-]*[0-9A-Za-z])[0-9A-Za-z_-]{32,}(?=[\"'])"
PATTERN = "|".join((SECRET, EMAIL, PHONE, NATIONAL, IP, CARD, NAME))
#: What every mention has; texts without it are not searched further.
HINT = rf"[@\d]|(?:{_TITLES})|[\"'][0-9A-Za-z_-]{{32}}"

#: Per script: onsets, vowels, and endings of given names (male, female) and family names.
SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v z br tr".split(), "a e i o u ai ea io".split(), ("n", "la"), "s"),
    "cyrillic": ("б в г д з к л м н п р с т ф бр тр".split(), "а е и о у я ё ю".split(), ("н", "ла"), "в"),
    "greek": ("β γ δ ζ κ λ μ ν π ρ σ τ φ χ βρ τρ".split(), "α ε η ι ο υ ω ου".split(), ("ς", "λα"), "δης"),
}
_HEX = "0123456789abcdef"


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 512)


def _digits(hexes: Column) -> Column:
    return F.translate(hexes, "abcdef", "258147")


def _letters(hexes: Column) -> Column:
    return F.translate(hexes, _HEX, "bcdfghjklmnprstv")


def _like(form: Column, hexes: Column) -> Column:
    """``form`` with its digits and letters replaced, place by place; other characters stay."""
    long = F.when(F.length(form) > 128, F.repeat(hexes, F.ceil(F.length(form) / 128).cast("int"))).otherwise(hexes)
    places = F.sequence(F.lit(1), F.length(form))

    def one(i: Column) -> Column:
        c, h = F.substring(form, i, F.lit(1)), F.substring(long, i, F.lit(1))
        letter = F.when(F.upper(c) == F.lower(c), c).when(c == F.upper(c), F.upper(_letters(h))).otherwise(_letters(h))
        return F.when(c.rlike(r"^\d$"), _digits(h)).when(c.rlike(r"^\p{L}$"), letter).otherwise(c)

    return F.when(F.length(form) > 0, F.array_join(F.transform(places, one), "")).otherwise("")


def _number(hexes: Column, at: int, below: int) -> Column:
    return F.pmod(F.conv(F.substring(hexes, at, 6), 16, 10).cast("bigint"), F.lit(below)).cast("int")


def _new_name(kind: Column, script: Column, hexes: Column, attempt: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (onsets, vowels, given, family) in SYLLABLES.items():
        starts, middles = F.array(*map(F.lit, onsets)), F.array(*map(F.lit, vowels))
        part = F.concat(*[F.concat(F.get(starts, _number(hexes, 1 + 12 * k, 16)), F.get(middles, _number(hexes, 7 + 12 * k, 8))) for k in range(3)])
        more = F.concat(F.get(starts, _number(hexes, 61, 16)), F.get(middles, _number(hexes, 67, 8)))
        part = F.concat(part, F.repeat(more, attempt.cast("int")))
        ending = F.when(kind == "given_male", given[0]).when(kind == "given_female", given[1]).otherwise(family)
        out = F.when(script == name, F.concat(part, ending)).otherwise(out)
    return out


def _split_mentions(mention: Column) -> Column:
    """The replaceable parts of one mention: structs (kind, value, script), in order; value is what coreference goes by."""
    digits = F.regexp_replace(mention, r"[^\d]", "")
    whole = (
        F.when(mention.contains("@"), F.lit("email"))
        .when(mention.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.lit("ip"))
        .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.lit("national"))
        .when(mention.rlike(r"^[+(]"), F.lit("phone"))
        .when(mention.rlike(r"^\d[\d -]*$") & (F.length(digits) <= 19), F.lit("card"))
        .otherwise(F.lit("secret"))
    )
    value = F.when(whole == "email", F.lower(mention)).when(whole.isin("phone", "card", "national"), digits).otherwise(mention)
    value = F.when((whole == "phone") & mention.startswith("+"), F.concat(F.lit("+"), digits)).otherwise(value)
    words = F.split(mention, " ")
    male = F.regexp_replace(words[0], r"\.$", "").isin(*MALE)
    last = F.size(words) - 1

    def script(word: Column) -> Column:
        return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")

    def part(word: Column, k: Column) -> Column:
        kind = F.when(k == last - 1, F.lit("family")).otherwise(F.when(male, "given_male").otherwise("given_female"))
        return F.struct(kind.alias("kind"), F.lower(word).alias("value"), script(word).alias("script"))

    names = F.transform(F.slice(words, 2, 2), part)
    plain = F.array(F.struct(whole.alias("kind"), value.alias("value"), F.lit("").alias("script")))
    return F.when(mention.rlike(f"^(?:{_TITLES})\\.? ") & (whole == "secret"), names).otherwise(plain)


def _surrogate(key: str, attempts: int) -> Column:
    """The surrogate of (kind, value, script) at an attempt, in the form of ``value``; after ``attempts`` longer than it."""
    hexes = _digest(key, F.col("kind"), F.col("value"), F.col("attempt"))
    beyond = F.least(F.greatest(F.col("attempt") - attempts, F.lit(0)) * 3, F.lit(60)).cast("int")
    letters, digits = (F.substring(f(F.reverse(hexes)), F.lit(1), beyond) for f in (_letters, _digits))
    local = F.substring_index("value", "@", 1)
    extra = F.substring(_letters(F.reverse(hexes)), F.lit(1), F.least(F.col("attempt") * 3, F.lit(60)).cast("int"))
    email = F.concat(_like(local, hexes), extra, F.lit("@"), F.lit("example."), F.get(F.array(F.lit("com"), F.lit("org"), F.lit("net")), _number(hexes, 100, 3)))
    ip = F.concat_ws(".", (_number(hexes, 1, 223) + 1).cast("string"), *[_number(hexes, 7 * k + 7, 256).cast("string") for k in range(3)])
    wide = F.concat(F.lit("fd00"), *[F.concat(F.lit(":"), F.substring(hexes, 1 + 4 * k, 4)) for k in range(7)])
    ip = F.when(beyond > 0, wide).otherwise(ip)
    # a leading country code stays: the digits that make the number longer than ten
    code = F.greatest(F.length("value") - 11, F.lit(0))
    phone = F.when(F.col("value").startswith("+"), F.concat(F.expr("substring(value, 1, greatest(length(value) - 11, 0) + 1)"), _like(F.substring(F.col("value"), code + 2, F.lit(40)), hexes))).otherwise(_like(F.col("value"), hexes))
    return (
        F.when(F.col("kind") == "email", email)
        .when(F.col("kind") == "ip", ip)
        .when(F.col("kind") == "phone", F.concat(phone, digits))
        .when(F.col("kind").isin("card", "national"), F.concat(_like(F.col("value"), hexes), digits))
        .when((F.col("kind") == "secret") & F.col("value").rlike("^[0-9a-f]+$"), F.substring(F.repeat(hexes, F.ceil((F.length("value") + beyond) / 128).cast("int")), F.lit(1), F.length("value") + beyond))
        .when(F.col("kind") == "secret", F.concat(_like(F.col("value"), hexes), letters))
        .otherwise(_new_name(F.col("kind"), F.col("script"), hexes, F.col("attempt")))
    )


def surrogate_table(values: DataFrame, key: str, attempts: int = 30) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value, script), all distinct per kind and none a value itself.

    What still clashes after ``attempts`` in its own form gets a longer surrogate,
    which grows with each further attempt until none clash.
    """
    table = checkpointed(values.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(key, attempts)))
    real = table.select("kind", F.col("value").alias("surrogate")).distinct().withColumn("real", F.lit(True))
    settle = Window.partitionBy("kind", "surrogate").orderBy("attempt", "value")
    while True:
        # a surrogate's clashes are few, as the hash spreads them
        judged = table.withColumn("place", F.row_number().over(settle)).join(real, ["kind", "surrogate"], "left")
        judged = judged.withColumn("again", (F.col("place") > 1) | F.col("real").isNotNull())
        if judged.filter("again").isEmpty():
            return table.select("kind", "value", "surrogate")
        judged = judged.withColumn("attempt", F.col("attempt") + F.col("again").cast("int"))
        table = checkpointed(judged.select("kind", "value", "script", "attempt").withColumn("surrogate", _surrogate(key, attempts)))


def _in_form(mention: Column, parts: Column) -> Column:
    """The mention with the surrogates of its parts, in its own punctuation and case."""
    first = F.get(parts, F.lit(0))
    digits = F.regexp_replace(first["surrogate"], r"[^\d]", "")
    spread = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(mention)),
            lambda i: F.when(
                F.substring(mention, i, F.lit(1)).rlike(r"^\d$"),
                F.substring(digits, F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), r"[^\d]", "")), F.lit(1)),
            ).otherwise(F.substring(mention, i, F.lit(1))),
        ),
        "",
    )
    had = F.length(F.regexp_replace(mention, r"[^\d]", ""))
    spread = F.concat(spread, F.substring(digits, had + 1, F.length(digits)))
    shout = F.when(mention == F.upper(mention), F.upper(first["surrogate"])).otherwise(first["surrogate"])
    words = F.split(mention, " ")

    def cased(p: Column, k: Column) -> Column:
        word = F.get(words, k + 1)
        return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(p["surrogate"])).otherwise(F.initcap(p["surrogate"]))

    name = F.concat(words[0], F.lit(" "), F.array_join(F.transform(parts, cased), " "))
    return (
        F.when(first["kind"].isin("phone", "card", "national"), spread)
        .when(first["kind"] == "email", shout)
        .when(first["kind"].isin("ip", "secret"), first["surrogate"])
        .otherwise(name)
    )


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the mentions in ``text`` replaced, plus n_mentions; ``key`` is the secret of the hash."""
    docs = make_room(docs, "n_mentions")
    own = docs.columns
    held = [f"c{i}" for i in range(len(own))]
    t = held[own.index(text)]
    rows = docs.toDF(*held).withColumn(t, F.col(t).cast("string"))
    hint = F.coalesce(F.col(t).rlike(HINT), F.lit(False))
    found = rows.withColumn("mentions", F.when(hint, F.regexp_extract_all(F.col(t), F.lit(PATTERN), F.lit(0))))
    some = F.coalesce(F.size("mentions") > 0, F.lit(False))
    with_some = found.filter(some).withColumn("key", F.xxhash64(t))
    # one row per distinct text with mentions, and their parts in order
    texts = with_some.groupBy("key").agg(F.first("mentions").alias("mentions"))
    said = texts.select("key", F.posexplode("mentions").alias("at", "mention"))
    parts = checkpointed(said.select("key", "at", "mention", F.posexplode(_split_mentions(F.col("mention"))).alias("part", "p")).select("key", "at", "mention", "part", "p.*"))
    table = surrogate_table(parts.select("kind", "value", "script"), key)
    joined = parts.join(table, ["kind", "value"])
    mention = joined.groupBy("key", "at", "mention").agg(F.array_sort(F.collect_list(F.struct("part", "kind", "surrogate"))).alias("parts"))
    mention = mention.select("key", "at", _in_form(F.col("mention"), F.col("parts")).alias("new"))
    news = mention.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias("news"))
    pieces = F.split(F.col(t), PATTERN)
    changed = with_some.join(news, "key")
    changed = changed.withColumns(
        {t: F.array_join(F.flatten(F.zip_with(pieces, F.concat("news", F.array(F.lit(""))), lambda a, b: F.array(a, b))), ""), "n": F.size("mentions").cast("bigint")}
    )
    same = found.filter(~some).withColumn("n", F.lit(0).cast("bigint"))
    return same.select(*held, "n").unionByName(changed.select(*held, "n")).toDF(*own, "n_mentions")


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return replace(docs, key="op3")
