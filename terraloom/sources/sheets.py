"""Yearly sheets of pesticide use, as CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions.clean import lookup, sand_falsk
from terraloom.functions.dates import plan_year
from terraloom.operators.mapping import union_all
from terraloom.operators.quality import assert_columns
from terraloom.sinks.publish import listed

#: Units by code.
AREA_UNITS = {1: "ha", 2: "m2", 3: "stk", 4: "m3", 5: "ton"}
DOSE_UNITS = {1: "g", 2: "kg", 3: "ml", 4: "l", 5: "tablet"}


def sheets(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All yearly sheets in `path` with their names and plan years. A sheet is a file, or a folder of part files; each is read
    by its own header, as their columns stand in different orders. One that cannot be read at all is passed over; none that
    can, a sheet without a needed column, and one without a plan year in its name are errors."""
    found = []
    for name in listed(spark, path):
        if name.startswith(("_", ".")):
            continue
        df = spark.read.option("header", True).option("ignoreCorruptFiles", True).csv(f"{path}/{name}")
        if df.columns:
            found.append(assert_columns(df, columns).select(*columns, F.lit(name).alias("source_file")))
    if not found:
        raise FileNotFoundError(f"no readable sheets in {path}")
    return union_all(found).withColumn("plan_year", plan_year(F.col("source_file")))


def typed(df: DataFrame, area_unit: str, dose_unit: str, none_used: str) -> DataFrame:
    """Unit codes as labels (unknown ones null), flags as booleans, and empty strings for null ones."""
    out = df.withColumns({area_unit: lookup(F.col(area_unit).try_cast("int"), AREA_UNITS), dose_unit: lookup(F.col(dose_unit).try_cast("int"), DOSE_UNITS), none_used: sand_falsk(F.col(none_used))})
    return out.fillna("")
