"""Steps between reading and publishing polygon layers: format, statistics, dissolve by status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.functions import wkb
from terraloom.operators import repair

#: Categories that are dissolved; ground that several claim goes to the first of them.
STATUS_ORDER = ("Action Required", "Completed")


def format_cells(df: DataFrame, code: str = "gridcode", geometry: str = "geometry") -> DataFrame:
    """(gridcode, geometry): codes as whole numbers (0 for what is none), null and empty geometries out, the others repaired,
    and what isn't simple after that out too."""
    number = F.coalesce(F.trim(F.col(code).cast("string")).try_cast("int"), F.lit(0)).alias(code)
    fixed = df.where(F.size(geometry) > 0).select(number, repair.repaired(F.col(geometry)).alias(geometry))
    return fixed.where(F.col(geometry).isNotNull()).where(repair.is_simple(F.col(geometry)))


def input_stats(df: DataFrame, binary: str = "geometry") -> DataFrame:
    """Features, those with a binary geometry, and those whose binary can be read, from one pass."""
    read = df.select(F.col(binary).isNotNull().alias("given"), wkb.from_wkb(F.col(binary)).alias("g"))
    return read.agg(F.count("*").alias("features"), F.count_if("given").alias("with_geometry"), F.count("g").alias("readable"))


def validated_stats(df: DataFrame) -> DataFrame:
    """Features that passed, and their points and areas."""
    of = lambda c, name: [F.round(F.avg(c), 6 if name == "points" else 1).alias(f"avg_{name}"), *(f(c if name == "points" else F.round(c, 1)).alias(f"{k}_{name}") for k, f in (("min", F.min), ("max", F.max)))]
    return df.agg(F.count("*").alias("features"), *of("num_points", "points"), *of("area_m2", "area"))


def dissolve_by_status(df: DataFrame, size: float, status: str = "status_category", order: tuple[str, ...] = STATUS_ORDER) -> DataFrame:
    """(status, geometry): each category's union as parts, without the ground of those before it in `order`; features of
    other categories are left out."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(status))
    ranked = df.select(status, "geometry", place.cast("int").alias("place")).where("place > 0")
    parts = repair.dissolved_parts(ranked, size, ["place"], rank="place")
    return parts.select(F.element_at(F.array(*map(F.lit, order)), F.col("place")).alias(status), "geometry")


def publish_dissolved(df: DataFrame, root: str, dataset: str) -> bool:
    """The dissolved layer beside the current one."""
    from terraloom.sinks.publish import publish

    return publish(df.withColumn("geometry", wkb.to_wkb(F.col("geometry"))), root, dataset, "dissolved_current")


def publish_checked(df: DataFrame, root: str, dataset: str, srid: int = 25832) -> bool:
    """A geometry layer through the gate (repaired, in degrees, simple), published as binary."""
    from terraloom.sinks.publish import publish

    return publish(repair.standard_pipeline(df, srid=srid).withColumn("geometry", wkb.to_wkb(F.col("geometry"))), root, dataset)
