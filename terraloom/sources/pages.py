"""Planning and reconciling landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that an unknown total is estimated from, its factor, and the sanity ceiling.
ESTIMATE_FACTOR, CEILING = 2000, 5_000_000


def page_plan(totals: DataFrame, size: int, layer: str = "layer", total: str = "total") -> DataFrame:
    """(layer, page, page_offset) of each expected page; a layer with no features is an error."""
    checked = F.when(F.col(total) > 0, F.col(total)).otherwise(F.raise_error(F.concat(F.lit("no features in "), F.col(layer).cast("string"))))
    planned = totals.select(layer, F.posexplode(F.sequence(F.lit(0).cast("long"), checked - 1, F.lit(size).cast("long"))).alias("page", "page_offset"))
    return planned.withColumn("page", F.col("page").cast("long"))


def missing_pages(plan: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    return plan.join(landed, keys, "left_anti")


def stated_total(text: Column, sample: Column) -> Column:
    """A page's stated number of features; '*' stands for an estimate, other text is an error."""
    return F.when(text == "*", sample * ESTIMATE_FACTOR).when(text.rlike("^[0-9]+$"), text.cast("bigint")).otherwise(F.raise_error(F.concat(F.lit("bad total "), F.coalesce(text, F.lit("null")))))


def reconcile(stated: DataFrame, parsed: DataFrame, layer: str = "layer") -> DataFrame:
    """Stated and parsed features by layer; either side may be missing. Totals above the ceiling are marked."""
    a = stated.groupBy(layer).agg(F.max("total").alias("stated"))
    b = parsed.groupBy(layer).agg(F.count("*").alias("parsed"))
    out = a.join(b, layer, "full").withColumns({"stated": F.coalesce("stated", F.lit(0).cast("long")), "parsed": F.coalesce("parsed", F.lit(0).cast("long"))})
    return out.withColumns({"difference": F.col("stated") - F.col("parsed"), "suspect": F.col("stated") > CEILING})


def newest_file(files: DataFrame, time: str = "modificationTime", path: str = "path") -> DataFrame:
    """The newest of landed files (binaryFile columns); ties go to the largest path. No file: an error."""
    found = files.agg(F.max_by(path, F.struct(time, path)).alias("path"))
    return found.select(F.when(F.col("path").isNotNull(), F.col("path")).otherwise(F.raise_error(F.lit("no landed file"))).alias("path"))
