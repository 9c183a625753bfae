"""The catalog of sources and the manifest of layers as tables, and what is joined to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions.dates import iso_date, next_update

#: The water layers that are read.
WATER_LAYERS = (
    "N2000_projekter:Hydrologi_E",
    "Ovrige_projekter:Vandloebsrestaurering_E",
    "Ovrige_projekter:Vandloebsrestaurering_F",
    "Vandprojekter:Fosfor_E_samlet",
    "Vandprojekter:Fosfor_F_samlet",
    "Vandprojekter:Kvaelstof_E_samlet",
    "Vandprojekter:Kvaelstof_F_samlet",
    "Vandprojekter:Lavbund_E_samlet",
    "Vandprojekter:Lavbund_F_samlet",
    "Vandprojekter:Private_vaadomraader",
    "Vandprojekter:Restaurering_af_aadale_2024",
    "vandprojekter:kla_projektforslag",
    "vandprojekter:kla_projektomraader",
    "Klima_lavbund_demarkation___offentlige_projekter:0",
)
#: Layers that another service than the general one has, and what kind of service it is.
OTHER_SERVICES = {
    "vandprojekter:kla_projektforslag": ("mim", "wfs"),
    "vandprojekter:kla_projektomraader": ("mim", "wfs"),
    "Klima_lavbund_demarkation___offentlige_projekter:0": ("nst", "arcgis"),
}


def water_layers(spark: SparkSession) -> DataFrame:
    """(layer_name, place, service, kind): the manifest of water layers in the order in which they are read. `kind` says which
    reader a layer's pages need."""
    rows = [(name, i, *OTHER_SERVICES.get(name, ("fvm", "wfs"))) for i, name in enumerate(WATER_LAYERS)]
    return spark.createDataFrame(rows, "layer_name string, place int, service string, kind string")


def routed(rows: DataFrame, manifest: DataFrame, layer: str = "layer_name") -> DataFrame:
    """Rows of the layers that the manifest has, with their service and kind; others are passed over. The manifest is as long as
    its fixed list, so it is broadcast."""
    return rows.join(F.broadcast(manifest.withColumnRenamed("layer_name", layer)), layer)


def freshness(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """(name, frequency, last_update, next_update) of each enabled source (name, enabled, frequency): the day of its last run in
    `runs` (name, at), and when the next is due. A source that never ran has no days; only weekly ones have a next."""
    last = runs.groupBy("name").agg(F.max("at").alias("last"))
    due = next_update(F.col("last"), F.col("frequency"))
    return sources.where("enabled").join(last, "name", "left").select("name", "frequency", iso_date("last").alias("last_update"), iso_date(due).alias("next_update"))
