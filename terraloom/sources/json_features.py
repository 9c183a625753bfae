"""Features in JSON: service pages with rings, GeoJSON collections, nested and line-delimited records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom.functions import geometry as G
from terraloom.functions.dates import epoch_millis
from terraloom.operators.mapping import rename, sanitise_columns
from terraloom.session import prepare

#: Source names of field and block attributes.
FIELD_NAMES = {
    "Marknr": "field_id", "IMK_areal": "area_ha", "Journalnr": "journal_number", "CVR": "cvr_number", "Afgkode": "crop_code", "Afgroede": "crop_type",
    "GB": "organic_farming", "GBanmeldt": "reported_area_ha", "Markblok": "block_id", "MB_NR": "block_id", "BLOKAREAL": "block_area_ha", "MARKBLOKTY": "block_type",
}
RINGS = "array<array<array<double>>>"


def rings_of(c: Column) -> Column:
    """Rings of [x, y] pairs as points; null for none."""
    return F.transform(c, lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))


def service_features(spark: SparkSession, path: str, attributes: str) -> DataFrame:
    """One row a feature of landed service pages: its attributes, its geometry by the rings' turn, srid 25832, and its
    place (path, pos). `attributes` is the declared schema of the attributes. Features without rings are no rows."""
    page = spark.read.schema(f"count long, features array<struct<attributes:struct<{attributes}>,geometry:struct<rings:{RINGS}>>>").json(path, multiLine=True)
    rows = page.select(F.col("_metadata.file_path").alias("path"), F.posexplode("features").alias("pos", "f"))
    rows = rows.where("size(f.geometry.rings) > 0")
    return rows.select("path", "pos", "f.attributes.*", G.rings_by_turn(rings_of(F.col("f.geometry.rings"))).alias("geometry"), F.lit(25832).alias("srid"))


def agricultural_fields(spark: SparkSession, path: str) -> DataFrame:
    names = ", ".join(f"`{k}`:string" for k in FIELD_NAMES)
    out = rename(service_features(spark, path, names), FIELD_NAMES)
    return sanitise_columns(out.withColumn("area_ha", F.col("area_ha").try_cast("double")))


def endpoint(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The pages of one endpoint (`fields`, `blocks` or a year's), with its name; each is stored as agricultural_<name>."""
    return agricultural_fields(spark, path).withColumn("dataset", F.lit(name))


def water_features(spark: SparkSession, path: str, layer: str) -> DataFrame:
    schema = "projektnavn:string, enhedskontakt:string, projektstart:long, projektslut:long, status:string, OBJECTID:long, GlobalID:string"
    out = service_features(spark, path, schema)
    return out.select(
        F.lit(layer).alias("layer_name"), "projektnavn", "enhedskontakt", epoch_millis(F.col("projektstart")).alias("startdato"), epoch_millis(F.col("projektslut")).alias("slutdato"),
        "status", F.col("OBJECTID").alias("object_id"), F.col("GlobalID").alias("global_id"), G.hectares(F.col("geometry")).alias("area_ha"), "geometry", "srid", "path", "pos",
    )


def geojson_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """One row a feature of GeoJSON pages of polygons; other geometries give null."""
    page = spark.read.schema(f"features array<struct<geometry:struct<type:string,coordinates:string>,properties:struct<{properties}>>>").json(path, multiLine=True)
    rows = page.select(F.col("_metadata.file_path").alias("path"), F.posexplode("features").alias("pos", "f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    one = F.array(rings_of(F.from_json(text, RINGS)))
    many = F.transform(F.from_json(text, f"array<{RINGS}>"), rings_of)
    return rows.select("path", "pos", "f.properties.*", F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many).alias("geometry"))


def feature_lines(df: DataFrame, geometry: str = "geometry", keep: tuple[str, ...] = ()) -> DataFrame:
    """(value): one GeoJSON feature a row, to be written as lines; columns to be kept stand before it."""
    coordinates = F.transform(geometry, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.array(q["x"], q["y"]))))
    properties = F.struct(*(c for c in df.columns if c != geometry))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))
    return df.select(*keep, F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), properties.alias("properties"))).alias("value"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, bad_most: int = 1000) -> DataFrame:
    """Records of JSON lines with a budget of bad ones; fields that aren't declared are passed over."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*declared.fields, T.StructField("_bad", T.StringType())])
    text = spark.read.text(path).where("trim(value) <> ''")
    parsed = text.select(F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).select("r.*")
    bad = parsed.where("_bad IS NOT NULL").limit(bad_most + 1).count()
    if bad > bad_most:
        raise ValueError(f"more than {bad_most} bad records")
    return parsed.where("_bad IS NULL").drop("_bad")


def zipped_records(spark: SparkSession, path: str, piece: int = 1 << 20) -> DataFrame:
    """(path, value): each feature's type and properties, as JSON, of the first .json member of each zip; geometry is
    left out and arrays stay arrays. A member is unpacked in pieces, and of it no more is held than a feature and a piece; the
    zip itself comes through Spark as one value (2 GB at most). A zip is one task's work, as its codec can't be split. A zip
    without such a member has no rows."""
    import pyarrow as pa

    def unzip(batches):
        import io
        import json
        import zipfile

        from terraloom.sources.json_stream import items

        def packed(name, values):
            return pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values, pa.string())], ["path", "value"])

        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                    member = next((m for m in z.namelist() if m.endswith(".json")), None)
                    if member is None:
                        continue
                    with z.open(member) as opened:
                        values, size = [], 0
                        for item in items(iter(lambda: opened.read(piece), b""), "features"):
                            f = json.loads(item)
                            values.append(json.dumps({"type": f.get("type"), "properties": f.get("properties")}))
                            size += len(values[-1])
                            if len(values) == 1000 or size > piece:
                                yield packed(name.as_py(), values)
                                values, size = [], 0
                        if values:
                            yield packed(name.as_py(), values)

    landed = prepare(spark).read.format("binaryFile").load(path).select("path", "content")
    return landed.mapInArrow(unzip, "path string, value string")


def collections(df: DataFrame, size: int = 10_000, geometry: str = "geometry", key: str | None = None) -> DataFrame:
    """(page, features, value): FeatureCollections of at most `size` features. Without a key a page is a number of its own and
    features come as they are; with one (a whole number), a page is the key divided by `size`, its features in the order of
    the key. No collection is longer than a page, so none is one task's whole input."""
    lines = feature_lines(df, geometry).withColumn("_n", F.monotonically_increasing_id()) if key is None else feature_lines(df, geometry, (key,)).withColumnRenamed(key, "_n")
    pages = lines.groupBy(F.floor(F.col("_n") / size).alias("page")).agg(F.count("*").alias("features"), F.array_sort(F.collect_list(F.struct("_n", "value"))).alias("found"))
    body = F.array_join(F.transform("found", lambda x: x["value"]), ",")
    return pages.select("page", "features", F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}")).alias("value"))
