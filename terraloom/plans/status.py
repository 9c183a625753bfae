"""Status categories and their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_category(status: Column, categories: dict[str, str], default: str = "Unknown") -> Column:
    """The category of a status; `default` for one that is not listed, null for none."""
    known = F.create_map(*(F.lit(x) for pair in categories.items() for x in pair))
    return F.when(status.isNotNull(), F.coalesce(F.try_element_at(known, status), F.lit(default)))


def category_counts(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy(category).agg(F.count("*").alias("features"))
