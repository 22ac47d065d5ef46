import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import parsing as P
from tidemark.operators.linkage import SCORED_POSITIONS, cutoff_counts, field_contrast, with_score
from tidemark.operators.profiling import column_stats, first_rows, score_stats, value_histogram


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


HEADER = "id_1,id_2,c0,c1,c2,c3,c4,c5,c6,c7,c8,is_match"
SAMPLE = "37291,53113,0.833333333333333,?,1,?,1,1,1,1,0,TRUE"


def test_sample_comparison_line(spark):
    row = P.parse_comparisons(lines(spark, HEADER, SAMPLE)).collect()
    assert len(row) == 1
    assert (row[0].id1, row[0].id2, row[0].matched) == (37291, 53113, True)
    assert row[0].scores == [pytest.approx(0.8333333), None, 1.0, None, 1.0, 1.0, 1.0, 1.0, 0.0]


def test_sample_score_and_cutoffs(spark):
    scored = with_score(P.parse_comparisons(lines(spark, HEADER, SAMPLE)))
    assert scored.first().score == 4.0
    counts = {r.cutoff: (r.matches, r.non_matches) for r in cutoff_counts(scored, [4.0, 4.5]).collect()}
    assert counts == {4.0: (1, 0), 4.5: (0, 0)}
    assert SCORED_POSITIONS == (2, 5, 6, 7, 8)


@pytest.mark.parametrize("word,expected", [("TRUE", True), ("true", True), ("yes", False), ("1", False), ("", False)])
def test_only_true_is_true(spark, word, expected):
    line = SAMPLE.rsplit(",", 1)[0] + "," + word
    assert P.parse_comparisons(lines(spark, line)).first().matched is expected


@pytest.mark.parametrize("bad", ["abc", "1.2.3"])
def test_bad_number_fails_or_is_null(spark, bad):
    frame = lines(spark, f"1,2,{bad},?,1,1,1,1,1,1,1,FALSE")
    with pytest.raises(Exception, match="not a valid number"):
        P.parse_comparisons(frame).collect()
    assert P.parse_comparisons(frame, lenient=True).first().scores[0] is None


def test_filtering_parsed_pairs_never_parses_the_header(spark):
    pairs = P.parse_comparisons(lines(spark, HEADER, SAMPLE))
    kept = pairs.filter("matched").filter(F.col("id1") > 0).filter(F.get("scores", F.lit(0)) > 0)
    assert kept.count() == 1


def test_id_names_drops_bad_lines(spark):
    frame = lines(
        spark, "1\tone", "2", "3\t", "x4\tfour", " 5\tfive", "99999999999\tbig", "6\tsix\tmore", "-7\tminus", "+8\tplus"
    )
    got = {(r.item, r.name) for r in P.parse_id_names(frame).collect()}
    assert got == {(1, "one"), (6, "six\tmore"), (-7, "minus"), (8, "plus")}


def test_aliases_strict_and_lenient(spark):
    fine = lines(spark, "1\t2", "\t3", "no tab")
    assert [(r.bad_id, r.good_id) for r in P.parse_aliases(fine).collect()] == [(1, 2)]
    broken = lines(spark, "1\t2", "x\t3")
    with pytest.raises(Exception, match="not a valid integer"):
        P.parse_aliases(broken).collect()
    assert P.parse_aliases(broken, lenient=True).count() == 1


def test_labelled_numbers_shift_the_class(spark):
    row = P.parse_labelled_numbers(lines(spark, "10,20,7")).first()
    assert (row.label, row["values"]) == (6.0, [10.0, 20.0])


@pytest.mark.parametrize("bits,expected", [("0,0,0,1", 3), ("1,0,0,0", 0), ("0,1,1,0", 2), ("0,0,0,0", 0)])
def test_collapse_takes_the_last_set_bit(spark, bits, expected):
    parsed = P.parse_labelled_numbers(lines(spark, f"5,6,{bits},0,1,1"))
    row = P.collapse_indicators(parsed, [(2, 4), (6, 2)]).first()
    assert row["values"] == [5.0, 6.0, float(expected), 1.0]


def test_connections_drop_word_columns_and_trailing_blanks(spark):
    row = P.parse_connections(lines(spark, "0.5,tcp,http,SF,3,4,normal.,,")).first()
    assert (row.label, row["values"]) == ("normal.", [0.5, 3.0, 4.0])


def test_statistics_of_the_three_small_arrays(spark):
    nan = float("nan")
    frame = spark.createDataFrame([([1.0, nan, 17.29],), ([nan, 15.39, 2.0],)], "scores ARRAY<DOUBLE>")
    stats = {r.idx: r for r in score_stats(frame).collect()}
    assert (stats[0]["count"], stats[0].missing, stats[0].mean) == (1, 1, 1.0)
    assert (stats[1]["count"], stats[1].missing, stats[1].mean) == (1, 1, 15.39)
    assert (stats[2]["count"], stats[2].missing) == (2, 0)
    assert stats[2].mean == pytest.approx(9.645)
    assert stats[2].stdev == pytest.approx((17.29 - 2.0) / 2)
    single = spark.createDataFrame([([10.0],), ([2.1],), ([nan],)], "scores ARRAY<DOUBLE>")
    row = score_stats(single).first()
    assert (row["count"], row.missing) == (2, 1) and row.mean == pytest.approx(6.05)


def test_all_missing_position_and_empty_input(spark):
    frame = spark.createDataFrame([([None],), ([None],)], "scores ARRAY<DOUBLE>")
    row = score_stats(frame).first()
    assert (row["count"], row.missing, row.mean, row.max) == (0, 2, None, None)
    assert score_stats(frame.limit(0)).count() == 0
    stats = column_stats(spark.createDataFrame([], "a DOUBLE"), ["a"]).first()
    assert (stats["count"], stats.missing, stats.mean) == (0, 0, None)


def test_field_contrast_matches_a_plain_loop(spark):
    import random

    random.seed(3)
    data = [
        ([None if random.random() < 0.3 else random.random() for _ in range(4)], random.random() < 0.4) for _ in range(200)
    ]
    frame = spark.createDataFrame(data, "scores ARRAY<DOUBLE>, matched BOOLEAN")
    for row in field_contrast(frame).collect():
        def mean(flag):
            found = [s[row.idx] for s, m in data if m is flag and s[row.idx] is not None]
            return math.fsum(found) / len(found)

        assert row.missing == sum(s[row.idx] is None for s, _ in data)
        assert row.mean_difference == pytest.approx(mean(True) - mean(False))


def test_distinct_count(spark):
    from tidemark.operators.profiling import distinct_count, row_count

    frame = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v STRING")
    assert row_count(frame).first().n == 4
    assert distinct_count(frame, "v").first().n == 2
    assert distinct_count(frame, "v", approximate=True).first().n == 2


def test_histogram_order_and_first_rows(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "v STRING")
    assert [(r.v, r.n) for r in value_histogram(frame, "v").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert [r.v for r in first_rows(frame, 2, "v").collect()] == ["a", "b"]
