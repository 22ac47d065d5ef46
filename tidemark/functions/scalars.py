"""Scalar column expressions shared by the operators."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed value: an optional sign and decimal digits, nothing else.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def int_or_null(text: Column, kind: str = "int") -> Column:
    """An integer with no surrounding blanks and no overflow, else NULL."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(kind))


def _or_fail(value: Column, text: Column, what: str, kind: str) -> Column:
    message = F.concat(F.lit(f"not a valid {what}: "), F.coalesce(text, F.lit("(missing)")))
    return F.coalesce(value, F.raise_error(message).cast(kind))


def strict_int(text: Column, kind: str = "int") -> Column:
    """As ``int_or_null``, but a bad value fails the job in any ANSI mode."""
    return _or_fail(int_or_null(text, kind), text, "integer", kind)


def strict_double(text: Column) -> Column:
    return _or_fail(text.try_cast("double"), text, "number", "double")


def number_or_missing(text: Column, marker: str = "?", lenient: bool = False) -> Column:
    """NULL for the missing marker, else a double.

    A field that is neither fails the job, or is NULL in lenient mode.
    """
    number = text.try_cast("double") if lenient else strict_double(text)
    return F.when(text != marker, number)


def is_true_word(text: Column) -> Column:
    """True for the word "true" in any case, false for everything else."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def known(value: Column) -> Column:
    """The value, or NULL where it is NaN."""
    return F.when(~F.isnan(value), value)


def zero_if_missing(value: Column) -> Column:
    return F.coalesce(known(value), F.lit(0.0))


def all_letters(text: Column) -> Column:
    """True when every character is a letter; also true for empty text."""
    return text.rlike(r"^\p{L}*$")


def last_field(line: Column, separator: str = ",") -> Column:
    """The last field of a line, trailing empty fields not counted."""
    kept = F.regexp_replace(line, f"{separator}+$", "")
    return F.element_at(F.split(kept, separator), -1)


def euclidean(a: Column, b: Column) -> Column:
    """Distance between two numeric arrays of one length."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))


def key_bucket(key: Column, buckets: int = 1000) -> Column:
    """A bucket in [0, buckets) from the key alone.

    The bucket of a row never depends on partitioning, and any engine with
    MD5 can compute it.
    """
    digits = F.substring(F.md5(key.cast("string")), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % buckets).cast("int")


def matrix_literal(rows: Sequence[Sequence[float]]) -> Column:
    """A small constant matrix as one foldable ``array<array<double>>``."""
    return F.from_json(F.lit(json.dumps([[float(v) for v in r] for r in rows])), "array<array<double>>")
