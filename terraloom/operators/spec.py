"""Declared datasets: what is read, how it is mapped, what identifies a row, and how it is published."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import wkb
from terraloom.operators import quality
from terraloom.operators.dedupe import first_seen
from terraloom.operators.mapping import Converter, map_fields, rename
from terraloom.sinks.publish import publish

#: The static wetland layer's names.
WETLAND_NAMES = {"OBJECTID": "wetland_id", "Kulstof": "carbon_content", "Areal_ha": "area_ha"}


@dataclass(frozen=True)
class Dataset:
    """A source's id, its reader, the mapping of its fields, its keys (rows without one are left out) and the order in which
    the first of rows with the same keys is kept."""

    source_id: str
    read: Callable[[SparkSession], DataFrame]
    fields: Sequence[tuple[str, str, Converter]]
    keys: Sequence[str]
    order: Sequence[str]

    def fetch(self, spark: SparkSession) -> DataFrame:
        out = map_fields(self.read(spark), self.fields)
        there = quality.assert_columns(out, self.keys).dropna(subset=list(self.keys))
        return first_seen(there, list(self.keys), list(self.order))

    def sync(self, spark: SparkSession, root: str) -> bool:
        """Fetched and published whole; False if there was nothing to publish."""
        return publish(self.fetch(spark), root, self.source_id)


def static_wetlands(spark: SparkSession, path: str) -> DataFrame:
    """The static wetland layer: renamed, only its four columns, shapes decoded."""
    df = rename(quality.assert_columns(spark.read.parquet(path), [*WETLAND_NAMES, "geometry"]), WETLAND_NAMES)
    return df.select(*WETLAND_NAMES.values(), wkb.from_wkb(F.col("geometry")).alias("geometry"))
