"""Declared mappings: a source's fields to a dataset's columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.clean import sanitised

Converter = Callable[[Column], Column]


def map_fields(df: DataFrame, fields: Sequence[tuple[str, str, Converter]], keep: Sequence[str] = ()) -> DataFrame:
    """(source, target, converter) of each field; a source that isn't there gives nulls, a value that can't be
    converted gives null in its field alone."""
    there = set(df.columns)
    return df.select(*keep, *((convert(F.col(src) if src in there else F.lit(None).cast("string"))).alias(dst) for src, dst, convert in fields))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renamed columns; of several sources of one target the first that isn't null is taken."""
    sources: dict[str, list[str]] = {}
    for src, dst in names.items():
        if src in df.columns:
            sources.setdefault(dst, []).append(src)
    taken = {s for group in sources.values() for s in group}
    kept = [F.col(c) for c in df.columns if c not in taken]
    return df.select(*kept, *(F.coalesce(*(F.col(s) for s in group)).alias(dst) for dst, group in sources.items()))


def sanitise_columns(df: DataFrame, lower: bool = False) -> DataFrame:
    return df.toDF(*(sanitised(c, lower) for c in df.columns))


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """A struct's fields as columns named <column>_<field>; a null struct gives nulls in its own row."""
    fields = df.schema[column].dataType.names
    return df.select(*(c for c in df.columns if c != column), *(F.col(f"{column}.{f}").alias(f"{column}_{f}") for f in fields))


def open_map(names: Column, values: Column) -> Column:
    """A map of a record's child elements: lower-case names, blank values left out; of a repeated name the last stays."""
    pairs = F.filter(F.arrays_zip(F.transform(names, lambda n: F.lower(n)).alias("k"), values.alias("v")), lambda p: F.trim(F.coalesce(p["v"], F.lit(""))) != "")
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"], F.trim(p["v"]))))


def as_published(df: DataFrame) -> DataFrame:
    """Timestamps as day strings and booleans as 0 or 1, by the columns' types."""
    cast = {"timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd"), "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd"), "date": lambda c: F.date_format(c, "yyyy-MM-dd"), "boolean": lambda c: c.cast("int")}
    return df.select(*(cast[t](F.col(c)).alias(c) if t in cast else F.col(c) for c, t in df.dtypes))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Pages, sheets and layers one after the other; columns that some lack are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
