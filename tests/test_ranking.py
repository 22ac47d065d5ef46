import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranking import dense_ids, nth_largest, top_per_group


def test_dense_ids_without_a_bound(spark):
    frame = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x")).repartition(7)
    got = dense_ids(frame, [F.desc("x")], "n").collect()
    assert sorted((r.n, r.x) for r in got) == [(i, 999 - i) for i in range(1000)]


def test_dense_ids_over_several_sorted_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x")).repartition(7)
        numbered = dense_ids(frame, ["x"], "n")
        assert numbered.rdd.getNumPartitions() > 1
        assert all(r.n == r.x for r in numbered.collect()) and numbered.count() == 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dense_ids_with_a_bound_and_when_empty(spark):
    frame = spark.range(5)
    assert [r.n for r in dense_ids(frame, ["id"], "n", max_rows=5).orderBy("id").collect()] == [0, 1, 2, 3, 4]
    assert dense_ids(frame.limit(0), ["id"], "n").count() == 0


@pytest.mark.parametrize("n,expected", [(1, 9), (3, 7), (100, 0)])
def test_nth_largest(spark, n, expected):
    assert nth_largest(spark.range(10), "id", n).first().id == expected


def test_top_per_group_is_cut_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id"))
    top = top_per_group(frame, "g", 3, [F.desc("id")])
    assert sorted((r.g, r.rank, r.id) for r in top.collect()) == [
        (0, 1, 998), (0, 2, 996), (0, 3, 994), (1, 1, 999), (1, 2, 997), (1, 3, 995)
    ]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
