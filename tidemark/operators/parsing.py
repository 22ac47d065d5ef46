"""Text lines to typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import int_or_null, is_true_word, last_field, number_or_missing, strict_double, strict_int
from ..functions.vectors import to_vector
from ..sources.delimited import split_columns, split_first_tab


# Fixed value: text that only header lines contain.
HEADER_MARK = "id_1"


def drop_header_lines(lines: DataFrame, header_mark: str = HEADER_MARK) -> DataFrame:
    """Remove the header line that every input file repeats."""
    return lines.filter(~F.col("value").contains(header_mark))


def parse_comparisons(
    lines: DataFrame,
    lenient: bool = False,
    missing: str = "?",
    id_type: str = "int",
    matched_position: int = 11,
) -> DataFrame:
    """``id1,id2,score,...,matched`` lines to (id1, id2, scores, matched).

    Missing scores are NULL.  Header lines are dropped.
    """
    # The failing conversions are guarded by the header test themselves: Spark
    # may evaluate a filter after the expressions of a later one.
    parts = F.split(F.when(~F.col("value").contains(HEADER_MARK), F.col("value")), ",")
    record = F.col("parts").isNotNull()
    read_id = int_or_null if lenient else strict_int
    middle = F.slice("parts", F.lit(3), F.greatest(F.size("parts") - 3, F.lit(0)))
    split_lines = lines.select(parts.alias("parts")).filter(record)
    return split_lines.select(
        F.when(record, read_id(F.get("parts", F.lit(0)), id_type)).alias("id1"),
        F.when(record, read_id(F.get("parts", F.lit(1)), id_type)).alias("id2"),
        F.transform(middle, lambda p: number_or_missing(p, missing, lenient)).alias("scores"),
        is_true_word(F.get("parts", F.lit(matched_position))).alias("matched"),
    )


def pick_positions(array: Column, positions: Sequence[int]) -> list[Column]:
    """Chosen 0-based positions of an array column."""
    return [F.get(array, F.lit(i)) for i in positions]


def parse_id_names(lines: DataFrame) -> DataFrame:
    """``id<TAB>name`` lines to (item, name).

    Lines with no tab, no whole-number id or an empty name are dropped.
    """
    count, left, rest = split_first_tab()
    return (
        lines.filter((count == 2) & (rest != ""))
        .select(int_or_null(left).alias("item"), rest.alias("name"))
        .filter(F.col("item").isNotNull())
    )


def parse_aliases(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """``bad_id<TAB>good_id`` lines to (bad_id, good_id).

    Lines with no tab or an empty left side are dropped; any other id that is
    not a whole number fails the job, or drops the line in lenient mode.
    """
    count, left, rest = split_first_tab()
    kept = (count == 2) & (left != "")
    read_id = int_or_null if lenient else strict_int
    pairs = lines.select(F.when(kept, read_id(left)).alias("bad_id"), F.when(kept, read_id(rest)).alias("good_id"))
    return pairs.dropna()


def parse_ratings(lines: DataFrame) -> DataFrame:
    """``user item count`` lines to (user, item, rating)."""
    fields = split_columns(lines, ["user", "item", "rating"])
    return fields.select(
        strict_int(F.col("user")).alias("user"),
        strict_int(F.col("item")).alias("item"),
        strict_int(F.col("rating")).cast("float").alias("rating"),
    )


def parse_labelled_numbers(lines: DataFrame) -> DataFrame:
    """``x1,...,xn,class`` lines to (label, values); class 1..k becomes 0..k-1."""
    parts = F.split(F.col("value"), ",")
    numbers = lines.select(F.transform(parts, strict_double).alias("all"))
    return numbers.select(
        (F.element_at("all", -1) - 1).alias("label"),
        F.slice("all", F.lit(1), F.size("all") - 1).alias("values"),
    )


def set_position(bits: Column) -> Column:
    """The position of the last 1 in a 0/1 array; 0 when there is none."""
    hits = F.transform(bits, lambda b, i: F.when(b == 1, i))
    return F.coalesce(F.array_max(hits), F.lit(0))


def collapse_indicators(df: DataFrame, groups: Sequence[tuple[int, int]], values: str = "values") -> DataFrame:
    """Replace runs of 0/1 columns in a numeric array by their set position.

    ``groups`` gives (first position, width) of each run, in order; the
    numbers ahead of the first run are kept, and one position follows per run.
    """
    first = groups[0][0]
    kept = F.slice(values, 1, first)
    collapsed = [set_position(F.slice(values, start + 1, width)).cast("double") for start, width in groups]
    return df.withColumn(values, F.concat(kept, F.array(*collapsed)))


def parse_connections(lines: DataFrame, dropped: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Comma-separated records to (label, values).

    The last field is the label; the ``dropped`` positions are left out and
    all other fields must be numbers.
    """
    trimmed = F.regexp_replace("value", ",+$", "")
    parts = lines.select(last_field(F.col("value")).alias("label"), F.split(trimmed, ",").alias("parts"))
    fields = F.slice("parts", F.lit(1), F.size("parts") - 1)
    numeric = F.filter(
        F.transform(fields, lambda p, i: F.struct(i.alias("i"), p.alias("p"))),
        lambda f: ~f["i"].isin(list(dropped)),
    )
    return parts.select("label", F.transform(numeric, lambda f: strict_double(f["p"])).alias("values"))


def with_features(df: DataFrame, values: str = "values", features: str = "features") -> DataFrame:
    """Add the vector form of a numeric array column."""
    return df.withColumn(features, to_vector(F.col(values)))
