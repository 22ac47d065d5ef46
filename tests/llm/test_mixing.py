import math
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import mixing

from .awkward import awkward, empty

SHARES = {"big": 400, "mid": 60, "small": 12}


def corpus(spark):
    rows, names = [], []
    for name, n in SHARES.items():
        for _ in range(n):
            rows.append((len(rows), "w " * (1 + len(rows) % 7)))
            names.append(name)
    index = F.array(*[F.lit(x) for x in SHARES])
    bounds = [400, 460]
    which = F.when(F.col("doc_id") < bounds[0], 0).when(F.col("doc_id") < bounds[1], 1).otherwise(2)
    return awkward(spark, rows, source=F.get(index, which))


def tokens(rows):
    out = Counter()
    for r in rows:
        out[r.source] += r.n_tokens
    return out


def plain_exponent(totals, target):
    """The definition, over the whole grid."""
    budget = sum(totals) * target.budget

    def at(a):
        z = sum(t**a for t in totals)
        w = [t**a / z for t in totals]
        return -sum(x * math.log(x) for x in w), max(x * budget / t for x, t in zip(w, totals, strict=True))

    grid = [k / 2**15 for k in range(2**15 + 1)]
    wanted = target.entropy * math.log(len(totals))
    return max(max(a for a in grid[:-1] if a == 0 or at(a)[0] >= wanted), min(a for a in grid[1:] if a == 1 or at(a)[1] <= target.repeats))


def test_weights_budget_and_permutations(spark):
    docs = corpus(spark)
    sizes = tokens(docs.select("source", mixing.token_count("text").alias("n_tokens")).collect())
    for target in (mixing.Target(), mixing.Target(entropy=0.6), mixing.Target(repeats=2.0), mixing.Target(entropy=1.0, repeats=50, budget=0.5)):
        sized = docs.select(F.col("source"), F.col("doc_id").cast("string").alias("id"), mixing.token_count("text").alias("tokens"))
        a = plain_exponent(list(sizes.values()), target)
        assert abs(mixing.exponent(mixing.source_totals(sized), target) - a) < 1e-9
        rows = mixing.mix(docs, target).collect()
        z = sum(t**a for t in sizes.values())
        for name, total in sizes.items():
            grant = total**a / z * target.budget * sum(sizes.values())
            mine = [r for r in rows if r.source == name]
            assert grant - 8 < sum(r.n_tokens for r in mine) <= grant + 1e-3
            passes = Counter(r.doc_id for r in mine)
            assert len(set(passes.values())) <= 2 and max(passes.values()) - min(passes.values()) <= 1
            for epoch in {r.epoch for r in mine}:
                ids = [r.doc_id for r in mine if r.epoch == epoch]
                assert len(ids) == len(set(ids))
            assert len({(r.epoch, r.order_key) for r in mine}) == len(mine)


def test_each_pass_has_another_order(spark):
    rows = [r for r in mixing.mix(corpus(spark)).collect() if r.source == "small"]
    orders = [[r.doc_id for r in sorted((r for r in rows if r.epoch == e), key=lambda r: r.order_key)] for e in (0, 1)]
    assert sorted(orders[0]) == sorted(orders[1]) and orders[0] != orders[1]


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    rows = mixing.mix(docs).collect()
    assert rows and {r.epoch for r in rows} >= {0}
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mix(awkward(spark, [(1, ""), (2, None)])).count() == 0
    one = mixing.mix(awkward(spark, [(0, "a b"), (0, "a b"), (3, "c")], source=F.lit("x"))).collect()
    assert sum(r.n_tokens for r in one) <= 5
