"""Joins against a side that is unique, or nearly unique, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import checkpointed

# A side is broadcast only when it is known to stay below these.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def hot_keys(df: DataFrame, on: str, hot_share: int = 1000) -> DataFrame:
    """The keys with about 1/``hot_share`` of all rows or more.

    A frequent-items sketch finds them in one pass that moves only one sketch
    per task, never the keys.  It lists at most ``hot_share`` keys.
    """
    sketch = F.call_function("approx_top_k", F.col(on), F.lit(hot_share), F.lit(4 * hot_share))
    found = df.agg(sketch.alias("_top"), F.count(on).alias("_rows"))
    items = found.select("_rows", F.explode_outer("_top").alias("_item"))
    return items.filter(F.col("_item.count") * hot_share >= F.col("_rows")).select(F.col("_item.item").alias(on))


def is_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether a frame is small enough to broadcast.

    Reads at most one row beyond ``max_rows``, and adds up the rows' sizes as
    text.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    size = F.octet_length(F.to_json(F.struct("*")))
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    max_rows: int | None = None,
    hot: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    costly_left: bool = False,
    hot_share: int = 1000,
    salts: int = 512,
) -> DataFrame:
    """Join ``lookup`` to ``left`` on one column, whatever the key skew.

    A small lookup is broadcast, after its rows were counted and measured:
    ``max_rows``, if given, is the bound they are held to.  A larger lookup is
    shuffled, and only hot keys are salted.  They are given as ``hot``, or
    found by reading the keys of ``left`` once more; with ``costly_left`` the
    left rows are checkpointed first, so that they are not computed twice.
    There are at most ``hot_share`` hot keys, so their table can always be
    broadcast.  Rows of a hot key are spread over ``salts`` tasks by a hash of
    ``salt_by`` (by default every other column), which gives the same answer
    when a lost task runs again; each lookup row of a hot key is repeated once
    per salt.  Which keys count as hot changes only the spread of the work,
    never the result.  ``how`` may be inner, left, left_semi or left_anti.
    """
    bound = BROADCAST_ROWS if max_rows is None else min(max_rows, BROADCAST_ROWS)
    if is_small(lookup, bound):
        return left.join(F.broadcast(lookup), on, how)

    if hot is None:
        left = checkpointed(left) if costly_left else left
        hot = hot_keys(left, on, hot_share)
    hot = hot.select(on, F.lit(True).alias("_hot"))
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))

    spread_over = list(salt_by) if salt_by else [c for c in left.columns if c != on]
    salt = F.pmod(F.xxhash64(*spread_over), F.lit(salts)).cast("int") if spread_over else F.lit(0)
    salted_left = (
        left.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.when(is_hot, salt).otherwise(0))
        .drop("_hot")
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_lookup = (
        lookup.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return salted_left.join(salted_lookup, [on, "_salt"], how).drop("_salt")


def resolve_aliases(rows: DataFrame, aliases: DataFrame, key: str = "item", max_rows: int | None = None) -> DataFrame:
    """Replace each ``key`` that has an alias by the good id it stands for."""
    unique = aliases.groupBy(F.col("bad_id").alias(key)).agg(F.min("good_id").alias("_good"))
    joined = lookup_join(rows, unique, key, "left", max_rows)
    resolved = F.coalesce("_good", key).alias(key)
    return joined.select(*[resolved if c == key else c for c in rows.columns])


def names_for(names: DataFrame, ids: DataFrame, key: str = "item") -> DataFrame:
    """The rows of ``names`` whose key occurs in ``ids``."""
    return names.join(ids.select(key).distinct(), key, "left_semi")


def exclude_terms(tokens: DataFrame, terms: DataFrame, term: str = "term", max_rows: int | None = None) -> DataFrame:
    """The rows whose term is not in the ``terms`` list."""
    listed = terms.select(F.col(terms.columns[0]).alias(term)).distinct()
    return lookup_join(tokens, listed, term, "left_anti", max_rows)
