"""Mixing sources to target weights: temperature mixing and budgeted block permutations.

A source of T tokens has the weight T^a / sum(T^a).  The exponent a is the
largest in [0, 1] whose entropy reaches the target, or, if some source would then
be repeated too often, the least that keeps the repetition limit.  It is found by
bisection on a grid of 2^-15; every pass over the table of sources evaluates all
points of five bisection steps.

A source's budget is its weight times the token budget: so many whole passes
(epochs), and of one more pass a part.  A pass is a permutation of the source's
blocks of documents and of the documents in each block, both by keyed hashes.
The partial pass takes documents in this order until one would exceed the budget.

Defined cases: a null source counts as the source ''; a null or empty text has
no tokens and goes where its block goes; sources without tokens get nothing;
repeated rows are taken together; a null id counts as the empty id; an empty
table stays empty.  Other columns pass through; one with the
name of a result is replaced by it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.blocks import make_room
from tidemark.sources.scratch import checkpointed

STEPS = 15
BLOCK_ROWS = 256
BLOCKS_PER_GROUP = 256
#: Up to so many sources, their budgets are broadcast (under 200 bytes each).
BROADCAST_SOURCES = 20_000


@dataclass(frozen=True)
class Target:
    """entropy: share of the largest possible; repeats: most passes over a source; budget: tokens, as a share of all."""

    entropy: float = 0.97
    repeats: float = 4.0
    budget: float = 1.0
    seed: str = "mix"


def token_count(text: str) -> Column:
    """Tokens ``[^\\x20\\x09-\\x0D]+`` of the text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_totals(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("rows"))


def _curve(totals: DataFrame, points: list[float]) -> list[tuple[float, float]]:
    """(entropy, most passes over a source of 1 / size, as a share of the budget) at each exponent."""
    size, logs = F.col("total").cast("double"), F.log(F.col("total").cast("double"))
    aggregates = [F.min(size).alias("least")]
    for k, a in enumerate(points):
        aggregates += [F.sum(F.pow(size, F.lit(a))).alias(f"z{k}"), F.sum(F.pow(size, F.lit(a)) * logs).alias(f"l{k}")]
    row = totals.agg(*aggregates).first()
    out = []
    for k, a in enumerate(points):
        z = row[f"z{k}"]
        out.append((math.log(z) - a * row[f"l{k}"] / z, row["least"] ** (a - 1.0) / z))
    return out


def exponent(totals: DataFrame, target: Target) -> float:
    """The exponent; sources are aggregated, never collected."""
    filled = totals.filter("total > 0")
    whole = filled.agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("tokens")).first()
    if not whole.n:
        return 1.0
    wanted = target.entropy * math.log(whole.n)
    budget = target.budget * whole.tokens

    def search(holds_below: bool, holds) -> float:
        """Bisect for the last point where ``holds`` (from 0 up), or the first (down from 1)."""
        low, high = 0.0, 1.0
        for _ in range(STEPS // 5):
            points = [low + (high - low) * k / 32 for k in range(1, 32)]
            good = [holds(x) for x in _curve(filled, points)]
            edges = [low, *points, high]
            k = sum(good) if holds_below else 31 - sum(good)
            low, high = edges[k], edges[k + 1]
        return low if holds_below else high

    by_entropy = search(True, lambda x: x[0] >= wanted)
    by_repeats = search(False, lambda x: x[1] * budget <= target.repeats)
    return max(by_entropy, by_repeats)


def _key(seed: str, *parts: Column) -> Column:
    """32 hex digits from the seed and the parts."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _below(key: Column, n: Column) -> Column:
    """A number in [0, n) from 8 hex digits of a key."""
    return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint"), n)


def _placed(sized: DataFrame, seed: str) -> DataFrame:
    """Adds the block, its group, and the three keys that order the partial pass; wants rows and whole."""
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.lit(1)).cast("bigint")
    out = sized.withColumn("block", _below(_key(seed, F.lit("block"), F.col("id")), blocks))
    out = out.withColumn("block_group", F.floor(F.col("block") / BLOCKS_PER_GROUP).cast("bigint"))
    return out.withColumns(
        {
            "group_key": F.substring(_key(seed, F.col("source"), F.col("whole"), F.lit("group"), F.col("block_group")), 1, 16),
            "block_key": F.substring(_key(seed, F.col("source"), F.col("whole"), F.lit("block"), F.col("block")), 1, 16),
            "doc_key": F.substring(_key(seed, F.col("source"), F.col("whole"), F.lit("doc"), F.col("id")), 1, 16),
        }
    )


def _with(df: DataFrame, table: DataFrame, few: bool) -> DataFrame:
    return df.join(F.broadcast(table) if few else table, "source")


def _first_over(rows: DataFrame, within: list[str], key: str) -> DataFrame:
    """Per source, the first row in key order at which the running total exceeds ``left``; left becomes what it may still take."""
    order = Window.partitionBy(*within).orderBy(key).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.withColumn("upto", F.sum("tokens").over(order)).filter("upto > left")
    first = F.min_by(F.struct(key, (F.col("left") - F.col("upto") + F.col("tokens")).alias("left")), key).alias("f")
    return running.groupBy("source").agg(first).select("source", f"f.{key}", "f.left")


def budgets(sized: DataFrame, target: Target = Target()) -> tuple[DataFrame, bool, float]:
    """Per source: rows, weight, whole passes, and the keys of the first document beyond the partial pass.

    ``sized`` has source, id, tokens.  Blocks are summed per (source, block), so a
    source of any size is spread over all tasks; running totals go over groups of
    blocks, then over the blocks of one group, then over the documents of one block.
    """
    totals = checkpointed(source_totals(sized))
    a = exponent(totals, target)
    whole = totals.agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("tokens"), F.sum(F.when(F.col("total") > 0, F.pow(F.col("total").cast("double"), F.lit(a)))).alias("z")).first()
    few = (whole.n or 0) <= BROADCAST_SOURCES
    weight = F.when(F.col("total") > 0, F.pow(F.col("total").cast("double"), F.lit(a)) / F.lit(whole.z or 1.0)).otherwise(0.0)
    plan = totals.withColumn("weight", weight)
    grant = F.floor(F.col("weight") * F.lit(target.budget * (whole.tokens or 0)) + 1e-6).cast("bigint")
    plan = plan.withColumn("grant", grant).withColumn("whole", F.when(F.col("total") > 0, F.floor(F.col("grant") / F.col("total"))).otherwise(0).cast("bigint"))
    plan = plan.withColumn("left", F.col("grant") - F.col("whole") * F.col("total"))
    placed = _placed(_with(sized, plan.select("source", "rows", "whole", "left"), few), target.seed)
    blocks = checkpointed(placed.groupBy("source", "left", "group_key", "block_key").agg(F.sum("tokens").alias("tokens")))
    groups = blocks.groupBy("source", "left", "group_key").agg(F.sum("tokens").alias("tokens"))
    cut_group = checkpointed(_first_over(groups, ["source"], "group_key"))
    inside = _with(blocks.drop("left").withColumnRenamed("group_key", "g"), cut_group, few).filter("g = group_key")
    cut_block = checkpointed(_first_over(inside, ["source"], "block_key"))
    keys = cut_group.select("source", "group_key").join(cut_block.select("source", "block_key", "left"), "source")
    last = placed.drop("left").withColumnsRenamed({"group_key": "g", "block_key": "b"})
    last = _with(last, keys, few).filter("g = group_key AND b = block_key")
    cut_doc = _first_over(last, ["source"], "doc_key").select("source", "doc_key")
    cuts = keys.select("source", "group_key", "block_key").join(cut_doc, "source", "left")
    cuts = cuts.toDF("source", "cut_group", "cut_block", "cut_doc")
    return checkpointed(plan.join(cuts, "source", "left")), few, a


def mix(docs: DataFrame, target: Target = Target(), doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document and pass: ``docs`` plus n_tokens, epoch and order_key.

    Sorting by (source, epoch, order_key) gives each source's block permutations.
    Texts are not shuffled.
    """
    docs = make_room(docs, "n_tokens", "epoch", "order_key")
    own = docs.columns
    held = [f"c{i}" for i in range(len(own))]
    name = {c: held[own.index(c)] for c in (doc_id, text, source)}
    rows = docs.toDF(*held)
    rows = rows.withColumns(
        {
            "source": F.coalesce(F.col(name[source]).cast("string"), F.lit("")),
            "id": F.coalesce(F.col(name[doc_id]).cast("string"), F.lit("")),
            "tokens": token_count(name[text]),
        }
    )
    sized = checkpointed(rows.select("source", "id", "tokens"))
    plan, few, _ = budgets(sized, target)
    placed = _placed(_with(rows, plan.select("source", "rows", "whole", "left", "cut_group", "cut_block", "cut_doc"), few), target.seed)
    mine = F.concat("group_key", "block_key", "doc_key")
    cut = F.concat("cut_group", "cut_block", F.coalesce("cut_doc", F.lit("g")))
    partial = (F.col("left") > 0) & F.coalesce(mine < cut, F.lit(True))
    passes = F.when(partial, F.col("whole") + 1).otherwise(F.col("whole"))
    taken = placed.filter(passes > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), passes - 1)))
    order = F.md5(F.concat_ws("|", F.col("epoch").cast("string"), F.col("group_key")))
    order = F.concat(F.substring(order, 1, 16), F.substring(F.md5(F.concat_ws("|", F.col("epoch").cast("string"), F.col("block_key"))), 1, 16), F.substring(F.md5(F.concat_ws("|", F.col("epoch").cast("string"), F.col("doc_key"))), 1, 16))
    order = F.when(F.col("epoch") < F.col("whole"), order).otherwise(mine)
    return taken.select(*held, "tokens", "epoch", order.alias("order_key")).toDF(*own, "n_tokens", "epoch", "order_key")


def query(spark, folder: str) -> DataFrame:
    return mix(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")).drop("text")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(source, '') AS src, CAST(doc_id AS VARCHAR) AS id,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents
), totals AS (SELECT src, CAST(sum(tokens) AS BIGINT) AS total, count(*) AS n FROM sized GROUP BY src
), grid AS (SELECT k / 32768.0::DOUBLE AS a FROM range(0, 32769) AS r(k)
), curve AS (
  SELECT a, ln(sum(pow(total, a))) - a * sum(pow(total, a) * ln(total)) / sum(pow(total, a)) AS entropy,
    pow(min(total), a - 1.0) / sum(pow(total, a)) * (SELECT sum(total) FROM totals) AS repeats
  FROM grid, totals WHERE total > 0 GROUP BY a
), chosen AS (
  SELECT greatest((SELECT max(a) FROM curve WHERE a < 1 AND (a = 0 OR entropy >= 0.97 * ln((SELECT count(*) FROM totals WHERE total > 0)))),
                  (SELECT min(a) FROM curve WHERE a > 0 AND (a = 1 OR repeats <= 4.0))) AS a
), plan AS (
  SELECT src, n, total, CAST(floor(pow(total, a) / (SELECT sum(pow(total, a)) FROM totals, chosen WHERE total > 0) * (SELECT sum(total) FROM totals) + 1e-6) AS BIGINT) AS granted
  FROM totals, chosen WHERE total > 0
), passes AS (SELECT *, granted // total AS whole, granted % total AS rest FROM plan
), blocked AS (
  SELECT s.*, whole, rest, ('0x' || substr(md5('mix|block|' || id), 1, 8))::BIGINT % CAST(ceil(n / 256.0) AS BIGINT) AS block
  FROM sized s JOIN passes USING (src)
), placed AS (
  SELECT *, substr(md5(concat_ws('|', 'mix', src, whole, 'group', block // 256)), 1, 16) AS gk,
    substr(md5(concat_ws('|', 'mix', src, whole, 'block', block)), 1, 16) AS bk,
    substr(md5(concat_ws('|', 'mix', src, whole, 'doc', id)), 1, 16) AS dk FROM blocked
), running AS (SELECT *, sum(tokens) OVER (PARTITION BY src ORDER BY gk, bk, dk RANGE UNBOUNDED PRECEDING) AS upto FROM placed
), cuts AS (SELECT src, min(gk || bk || dk) AS cut FROM running WHERE upto > rest GROUP BY src
), counted AS (
  SELECT p.*, whole + CASE WHEN rest > 0 AND coalesce(gk || bk || dk < cut, true) THEN 1 ELSE 0 END AS times FROM placed p LEFT JOIN cuts USING (src)
)
SELECT doc_id, source, CAST(tokens AS BIGINT) AS n_tokens, CAST(e AS BIGINT) AS epoch,
  CASE WHEN e < whole THEN substr(md5(e || '|' || gk), 1, 16) || substr(md5(e || '|' || bk), 1, 16) || substr(md5(e || '|' || dk), 1, 16) ELSE gk || bk || dk END AS order_key
FROM counted, unnest(range(0, times)) AS u(e)
"""
