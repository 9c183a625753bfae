"""Checks of datasets: required columns, rejects with a reason, profiles, success rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def assert_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    if missing := missing_columns(df, required):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def assert_not_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the dataset has no rows")
    return df


def assert_srid(df: DataFrame, expected: int = 4326, column: str = "srid") -> DataFrame:
    """Null counts as the expected one; any other is an error, raised where the rows are."""
    c = F.coalesce(F.col(column), F.lit(expected))
    return df.withColumn(column, F.when(c == expected, c).otherwise(F.raise_error(F.concat(F.lit("unexpected srid "), c.cast("string")))))


def with_reason(df: DataFrame, rules: Mapping[str, Column], name: str = "reject_reason") -> DataFrame:
    """The name of the first rule that a row breaks, or null. A rule that comes out null is broken."""
    reason = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(k)) for k, ok in rules.items()))
    return df.withColumn(name, reason)


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, the others with reject_reason)."""
    marked = with_reason(df, rules)
    return marked.where("reject_reason IS NULL").drop("reject_reason"), marked.where("reject_reason IS NOT NULL")


def non_null_profile(df: DataFrame) -> DataFrame:
    """(column, non_null, rows) of each column, from one pass."""
    counted = df.agg(F.count("*").alias("_rows"), *(F.count(F.col(c)).alias(c) for c in df.columns))
    return counted.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null"), F.col("_rows").alias("rows")) for c in df.columns))).alias("r")).select("r.*")


def success_rates(df: DataFrame, page: str, valid: Column, warn_below: float = 0.5) -> DataFrame:
    """Rows and valid rows a page, with a warning if none or fewer than `warn_below` are valid."""
    out = df.groupBy(page).agg(F.count("*").alias("features"), F.count_if(valid).alias("valid"))
    rate = F.col("valid") / F.col("features")
    return out.withColumn("warning", F.when(F.col("valid") == 0, "none valid").when(rate < warn_below, "few valid"))


def removed_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows before and after, and how many each rule removes first, from one pass."""
    marked = with_reason(df, rules)
    return marked.agg(F.count("*").alias("before"), F.count_if(F.col("reject_reason").isNull()).alias("after"), *(F.count_if(F.col("reject_reason") == k).alias(f"removed_{k}") for k in rules))


def check_table(df: DataFrame, checks: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """(check, severity, failing_rows) of each check; a condition that holds is a failure."""
    counted = df.agg(*(F.count_if(bad).alias(k) for k, (_, bad) in checks.items()))
    return counted.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.lit(s).alias("severity"), F.col(k).alias("failing_rows")) for k, (s, _) in checks.items()))).alias("r")).select("r.*")


def structure_profile(df: DataFrame, json_column: str) -> DataFrame:
    """(key, records): how many records have each top-level key."""
    return df.select(F.explode(F.array_distinct(F.json_object_keys(json_column))).alias("key")).groupBy("key").agg(F.count("*").alias("records"))


def has_rows() -> Column:
    return F.count("*") > 0


def has_columns(df: DataFrame, names: Sequence[str]) -> Column:
    """A constant: the columns are known before a row is read."""
    return F.max(F.lit(not missing_columns(df, names)))


def all_rows(ok: Column) -> Column:
    """Whether a condition holds in every row; null counts as broken."""
    return F.coalesce(F.bool_and(F.coalesce(ok, F.lit(False))), F.lit(True))


def contracts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check, ok) of a step's output, from one pass."""
    held = df.agg(*(c.alias(k) for k, c in checks.items()))
    return held.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.coalesce(F.col(k), F.lit(False)).alias("ok")) for k in checks))).alias("r")).select("r.*")
