import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookups
from tidemark.operators.lookups import hot_keys, is_small, lookup_join, names_for, resolve_aliases


@pytest.fixture()
def skewed(spark):
    """A third of 3,000 rows share key 7; key 8 is missing from the lookup."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("int").alias("k"), F.col("id").alias("v")
    )
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k INT, v BIGINT"))
    lookup = spark.range(600).filter("id <> 8").select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("w"))
    return left.persist(), lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("costly", [False, True])
def test_salted_join_equals_plain_join(skewed, monkeypatch, how, costly):
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 10)
    left, lookup = skewed
    salted = lookup_join(left, lookup, "k", how, max_rows=1000, hot_share=20, salts=16, costly_left=costly)
    plain = left.join(lookup, "k", how)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_given_hot_keys_change_nothing(skewed, spark):
    left, lookup = skewed
    hot = spark.createDataFrame([(3,), (7,)], "k INT")
    salted = lookup_join(left, lookup, "k", "left", max_rows=100, hot=hot)
    assert sorted(map(str, salted.collect())) == sorted(map(str, left.join(lookup, "k", "left").collect()))


def test_hot_key_is_found_and_spread(skewed):
    left, lookup = skewed
    found = {r.k for r in hot_keys(left, "k", 20).collect()}
    assert found == {7}
    joined = lookup_join(left, lookup, "k", max_rows=100, hot_share=20, salts=16)
    assert "_salt" not in joined.columns
    hot = left.filter("k = 7").select(F.pmod(F.xxhash64("v"), F.lit(16)).alias("s")).groupBy("s").count()
    assert hot.count() == 16


def test_no_rows_at_all(skewed):
    left, lookup = skewed
    assert lookup_join(left.limit(0), lookup, "k", max_rows=100).count() == 0
    assert hot_keys(left.limit(0), "k").count() == 0


def test_small_lookup_is_broadcast_large_is_not(skewed):
    left, lookup = skewed
    assert is_small(lookup, 599) and not is_small(lookup, 598)
    assert not is_small(lookup, 599, max_bytes=1000)
    assert is_small(lookup.limit(0))

    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(lookup_join(left, lookup, "k"))
    large = plan(lookup_join(left, lookup, "k", max_rows=100))
    assert "_salt" in large


def test_aliases_resolve_once_and_keep_other_items(spark):
    rows = spark.createDataFrame([(1, 10, 2.0), (1, 11, 3.0), (2, 12, 1.0)], "user INT, item INT, rating DOUBLE")
    aliases = spark.createDataFrame([(10, 11), (10, 11), (99, 1)], "bad_id INT, good_id INT")
    got = sorted(tuple(r) for r in resolve_aliases(rows, aliases).collect())
    assert got == [(1, 11, 2.0), (1, 11, 3.0), (2, 12, 1.0)]


def test_names_for_repeated_ids(spark):
    names = spark.createDataFrame([(1, "a"), (2, "b")], "item INT, name STRING")
    ids = spark.createDataFrame([(1,), (1,), (5,)], "item INT")
    assert [tuple(r) for r in names_for(names, ids).collect()] == [(1, "a")]
