import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import (
    checkpointed,
    read_header_csv,
    read_lines,
    read_numeric_csv,
    read_tagged_xml,
    read_word_list,
    scratch_path,
    split_columns,
    spread_small_scan,
    write_lines,
    write_tagged_xml,
)


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_lines_round_trip_and_no_overwrite(spark):
    path = scratch_path(spark, "t")
    write_lines(frame(spark, "a", "", "b\tc"), path)
    assert sorted(r.value for r in read_lines(spark, path).collect()) == ["", "a", "b\tc"]
    assert read_lines(spark, f"{path}/part-*").count() == 3
    with pytest.raises(Exception, match="exist"):
        write_lines(frame(spark, "a"), path)


def test_word_list_splits_two_words_on_a_line(spark):
    path = scratch_path(spark, "t")
    write_lines(frame(spark, "our", "Ours\tourselves", "our", " out "), path)
    assert sorted(r.term for r in read_word_list(spark, path).collect()) == ["our", "ours", "ourselves", "out"]


def test_numeric_csv(spark):
    path = scratch_path(spark, "t")
    write_lines(frame(spark, "1,2.5", "3,-4"), path)
    assert sorted(tuple(r) for r in read_numeric_csv(spark, path, ["a", "b"]).collect()) == [(1.0, 2.5), (3.0, -4.0)]
    bad = scratch_path(spark, "t")
    write_lines(frame(spark, "1,x"), bad)
    with pytest.raises(Exception):
        read_numeric_csv(spark, bad, ["a", "b"]).collect()


def test_header_in_every_file(spark):
    path = scratch_path(spark, "t")
    for i in range(3):
        write_lines(frame(spark, "id_1,c,is_match", f"{i},?,TRUE").coalesce(1), f"{path}/block_{i}")
    got = read_header_csv(spark, f"{path}/block_*", "id_1 INT, c DOUBLE, is_match BOOLEAN")
    assert sorted(tuple(r) for r in got.collect()) == [(i, None, True) for i in range(3)]


def test_space_separated_fields(spark):
    got = split_columns(frame(spark, "1 2 3", "4 5"), ["a", "b", "c"]).collect()
    assert [tuple(r) for r in got] == [("1", "2", "3"), ("4", "5", None)]


def test_tagged_xml(spark):
    schema = "title STRING, ns INT, redirect STRUCT<_title: STRING>, revision STRUCT<text: STRING>"
    pages = [("A & B", 0, None, ("x < y\nz",)), ("Old", 0, ("A & B",), ("",)), ("T", 1, None, ("[[t]]",))]
    path = scratch_path(spark, "t")
    write_tagged_xml(spark.createDataFrame(pages, schema).coalesce(1), path)
    got = {r.title: r for r in read_tagged_xml(spark, path).collect()}
    assert len(got) == 3
    assert got["A & B"].revision.text == "x < y\nz" and got["A & B"].redirect is None
    assert got["Old"].redirect._title == "A & B" and got["T"].ns == 1


def test_spread_only_small_scans(spark):
    cores = spark.sparkContext.defaultParallelism
    small = spark.range(0, 10, 1, 1)
    assert spread_small_scan(small, "id").rdd.getNumPartitions() == cores
    wide = spark.range(0, 10, 1, cores)
    assert spread_small_scan(wide, "id") is wide


def test_checkpoint_cuts_the_plan(spark):
    kept = checkpointed(spark.range(5).select((F.col("id") * 2).alias("x")))
    assert sorted(r.x for r in kept.collect()) == [0, 2, 4, 6, 8]
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_a_checkpoint_can_free_its_shuffles(spark):
    top = Path(spark.sparkContext._temp_dir).parents[1]

    def shuffled():
        return len(list(top.glob("blockmgr-*/*/shuffle_*")))

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled(), spark.conf.get(setting)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7)
    frame = rows.groupBy("k").agg(F.count("id").alias("n")).join(rows.hint("merge"), "k").groupBy("k").agg(F.sum("n").alias("s"))
    kept = checkpointed(frame, free=True)
    until = time.time() + 20
    while shuffled() > before and time.time() < until:
        time.sleep(0.1)
    assert shuffled() <= before
    assert sorted(r.s for r in kept.collect()) == [142 * 142] + [143 * 143] * 6 and kept.count() == 7
    assert spark.conf.get(setting) == was


def test_kept_leaves_a_persisted_frame_alone(spark):
    from tidemark.sources import kept

    mine = spark.range(7).persist()
    with kept(mine) as same:
        assert same is mine
    assert mine.is_cached and mine.storageLevel.useMemory
    mine.unpersist()
    with kept(spark.range(8)) as other:
        assert other.storageLevel.useMemory
    assert not other.storageLevel.useMemory


def test_narrow_rows_are_dealt_by_their_number(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    spark.range(1000).coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert spread_small_scan(spark.read.parquet(path), "id", rows=1000).rdd.getNumPartitions() == cores
    assert spread_small_scan(spark.read.parquet(path), "id", rows=20).rdd.getNumPartitions() == max(cores, 50)
