"""Nitrogen accounts of farms and their fields, and support amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARES = ("F_610", "F_706_1", "F_193")


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def farm_accounts(farms: DataFrame) -> DataFrame:
    """Original and final quota, adjustment factor (1 without an original quota), performance and source shares."""
    original = F.coalesce("F_504_1", F.lit(0.0)) + F.coalesce("F_505_1", F.lit(0.0))
    out = farms.withColumn("original_quota", original).withColumn("final_quota", F.coalesce("F_512", "original_quota"))
    out = out.withColumn("factor", F.coalesce(ratio(F.col("final_quota"), F.col("original_quota")), F.lit(1.0)))
    return out.withColumns({"performance": ratio(F.col("F_901"), F.col("final_quota"))} | {f"share_{c}": ratio(F.col(c), F.col("F_901")) for c in SHARES})


def field_accounts(accounts: DataFrame, fields: DataFrame, key: str = "CVR") -> DataFrame:
    """A farm's account pushed down to its fields: adjusted quota, consumption, its percentage, and its split by source.
    A field without harmonised area gets nothing. The join's strategy is left to the planner: farms may be many."""
    out = fields.join(accounts, key)
    adjusted = F.when(F.col("harmoni_areal") > 0, F.col("n_kvote") * F.col("factor"))
    out = out.withColumn("adjusted_quota", adjusted).withColumn("consumption", F.col("adjusted_quota") * F.col("performance"))
    split = {f"consumption_{c}": F.col("consumption") * F.col(f"share_{c}") for c in SHARES}
    return out.withColumns({"consumption_pct": ratio(F.col("consumption"), F.col("adjusted_quota")) * 100} | split)


def support_amounts(areas: DataFrame, scheme: str, rate: str, eligible: str) -> DataFrame:
    """Rate times eligible area, before reductions, by scheme."""
    return areas.groupBy(scheme).agg(F.sum(F.col(rate) * F.col(eligible)).alias("amount"), F.count("*").alias("areas"))


def checks() -> dict[str, tuple[str, Column]]:
    """Checks of farm accounts with their fields: (severity, what fails). Missing fields mean a number without a match."""
    shares = sum((F.col(f"share_{c}") for c in SHARES), F.lit(0.0))
    no = lambda c: F.coalesce(c, F.lit(False))
    return {
        "shares": ("error", F.abs(shares - 1) > 1e-9),
        "quota": ("error", F.col("original_quota") == 0),
        "high": ("warning", no(F.col("performance") > 0.9)),
        "negative": ("warning", no(F.col("transfer") < 0)),
        "matched": ("error", F.col("area").isNull()),
        "harmonised": ("error", no(F.col("harmonised_area") > F.col("area"))),
    }
