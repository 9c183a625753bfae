"""Cleaning of register values: null-safe Column -> Column functions, none of which can fail on bad input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def clean_text(c: Column) -> Column:
    """Without white space of any kind at the ends; null if nothing is left."""
    return F.nullif(F.regexp_replace(c.cast("string"), _EDGES, ""), F.lit(""))


def to_int(c: Column) -> Column:
    """A whole number; null for blanks and for anything else, also '12.5'. Matched once; what does not match is null before the cast, which is slow
    where it fails."""
    return F.nullif(F.regexp_extract(c.cast("string"), r"\A[\s\p{Z}]*([+-]?[0-9]+)[\s\p{Z}]*\z", 1), F.lit("")).try_cast("bigint")


def to_float(c: Column) -> Column:
    """A number with a decimal comma or point; null if it can't be read."""
    return F.replace(clean_text(c), F.lit(","), F.lit(".")).try_cast("double")


def digits_to_float(c: Column) -> Column:
    """What digits and points are left of a text, as a number; null if that is none."""
    return F.nullif(F.regexp_replace(c.cast("string"), "[^0-9.]", ""), F.lit("")).try_cast("double")


def is_true(c: Column) -> Column:
    return F.lower(c.cast("string")) == "true"


def yes_flag(c: Column) -> Column:
    """1 for the register's yes, else 0, also for null."""
    return F.coalesce((c == "Ja").cast("int"), F.lit(0))


def sand_falsk(c: Column) -> Column:
    return F.when(c == "SAND", F.lit(True)).when(c == "FALSK", F.lit(False))


def lookup(c: Column, labels: Mapping, default=None) -> Column:
    """The label of a code; `default` for an unknown one, null for null."""
    known = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    return F.when(c.isNotNull(), F.coalesce(F.try_element_at(known, c), F.lit(default)))


def peat_class(gridcode: Column) -> Column:
    """Peat share of a grid code; a missing code counts as 0, which has none."""
    return lookup(F.coalesce(gridcode.try_cast("int"), F.lit(0)), {12: "6-12%", 60: ">12%"})


def person_id(cvr: Column, cpr: Column) -> Column:
    """The first of company and person number that isn't blank."""
    return F.coalesce(clean_text(cvr), clean_text(cpr))


def positive(c: Column) -> Column:
    """The number, or null for 0."""
    return F.nullif(c, F.lit(0))


#: Inclusive count ranges, which share their ends.
COUNT_BUCKETS = (("0-100", 0, 100), ("100-1000", 100, 1000), ("1000-5000", 1000, 5000), ("5000-9999", 5000, 9999), ("10000", 10000, 10000), (">10000", 10001, None))


def bucket_counts(c: Column, buckets=COUNT_BUCKETS) -> list[Column]:
    """One aggregate a range; a count on a shared end is in both."""
    return [F.count_if((c >= low) & (c <= high if high is not None else F.lit(True))).alias(f"n_{i}") for i, (_, low, high) in enumerate(buckets)]


def sanitised(name: str, lower: bool = False) -> str:
    """A column name without dots, parentheses and blanks."""
    if lower:
        return name.replace(".", "_").replace(" ", "_").lower()
    return name.translate(str.maketrans({".": "_", "(": "_", ")": "_"}))
