"""Feature pages in XML: one row a feature, by Spark's own XML reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.functions.clean import clean_text, digits_to_float, is_true, to_int
from terraloom.functions.dates import day_first, iso_timestamp
from terraloom.plans.status import status_category

#: The cadastral register's fields.
CADASTRAL_FIELDS = (
    ("BFEnummer", "bfe_number", to_int),
    ("forretningshaendelse", "business_event", clean_text),
    ("forretningsproces", "business_process", clean_text),
    ("senesteSagLokalId", "latest_case_id", clean_text),
    ("id_lokalId", "id_local", clean_text),
    ("id_namespace", "id_namespace", clean_text),
    ("registreringFra", "registration_from", iso_timestamp),
    ("virkningFra", "effect_from", iso_timestamp),
    ("virkningsaktoer", "authority", clean_text),
    ("arbejderbolig", "is_worker_housing", is_true),
    ("erFaelleslod", "is_common_lot", is_true),
    ("hovedejendomOpdeltIEjerlejligheder", "has_owner_apartments", is_true),
    ("udskiltVej", "is_separated_road", is_true),
    ("landbrugsnotering", "agricultural_notation", clean_text),
)

#: How water projects' open fields are typed.
WATER_FIELDS = {"area": digits_to_float, "budget": digits_to_float, "startaar": to_int, "tilsagnsaa": to_int, "slutaar": to_int, "startdato": day_first, "slutdato": day_first}


#: What the states of protected areas come to.
PROTECTION_STATUS = {
    "Frivillig aftale tilbudt (UDGÅET)": "Action Required",
    "Gennemgået, indsats nødvendig": "Action Required",
    "Ikke gennemgået (default værdi)": "Action Required",
    "Gennemgået, indsats ikke nødvendig": "Completed",
    "Indsats gennemført": "Completed",
    "Ingen erhvervsmæssig anvendelse af pesticider": "Completed",
}


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, page_xml): each page whole, for page-level attributes and open schemas."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("page_xml"))


def page_totals(pages: DataFrame) -> DataFrame:
    """(path, matched, returned) as the pages state them."""
    attribute = lambda name: F.nullif(F.xpath_string("page_xml", F.lit(f"/*/@{name}")), F.lit(""))
    return pages.select("path", attribute("numberMatched").alias("matched"), attribute("numberReturned").alias("returned"))


def features(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Features with a declared schema; what can't be parsed is dropped and its page goes on."""
    return spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true").option("mode", "DROPMALFORMED").schema(schema).load(path)



def local(name: str) -> str:
    return f"*[local-name()='{name}']"


def open_features(pages: DataFrame, row: str) -> DataFrame:
    """(path, pos, feature_xml): each feature's own XML, cut at its tag, for sources whose fields aren't known."""
    cut = F.regexp_extract_all("page_xml", F.lit(rf"(?s)<((?:\w+:)?{row})(?:\s[^>]*)?>.*?</(?:\w+:)?{row}>"), F.lit(0))
    plain = F.regexp_replace(F.regexp_replace("feature", r"(</?)\w+:", "$1"), r"\s\w+:(\w+=)", " $1")
    return pages.select("path", F.posexplode(cut).alias("pos", "feature")).select("path", "pos", plain.alias("feature_xml"))


def open_fields(xml: Column, geometry: str) -> Column:
    """A map of a feature's simple children, lower-case names, blank values and the geometry left out."""
    tags = F.regexp_extract_all(xml, F.lit(r"<([A-Za-z_][\w.-]*)(?:\s[^>]*)?>[^<]*</\1>"), F.lit(1))
    values = F.regexp_extract_all(xml, F.lit(r"<([A-Za-z_][\w.-]*)(?:\s[^>]*)?>([^<]*)</\1>"), F.lit(2))
    pairs = F.zip_with(tags, values, lambda k, v: F.struct(F.lower(k).alias("k"), clean_text(v).alias("v")))
    skip = ("poslist", "pos", "coordinates", geometry.lower())
    kept = F.filter(pairs, lambda p: p["v"].isNotNull() & ~p["k"].isin(*skip))
    once = F.filter(kept, lambda p, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(once)


def surface_geometry(xml: Column, dimensions: int = 2) -> Column:
    """Polygons of a feature: shells from exterior rings and holes from interior ones; rings of fewer than four points
    are left out, and a feature without any is null."""
    polygons = F.regexp_extract_all(xml, F.lit(r"(?s)<Polygon(?:\s[^>]*)?>.*?</Polygon>"), F.lit(0))
    parts = lambda p, side: F.regexp_extract_all(p, F.lit(rf"(?s)<{side}>.*?<posList[^>]*>([^<]*)</posList>.*?</{side}>"), F.lit(1))
    bare = lambda p: F.regexp_extract_all(p, F.lit(r"(?s)<posList[^>]*>([^<]*)</posList>"), F.lit(1))

    def built(p: Column) -> Column:
        outer = F.when(F.size(parts(p, "exterior")) > 0, F.concat(parts(p, "exterior"), parts(p, "interior"))).otherwise(bare(p))
        return F.filter(F.transform(outer, lambda t: G.ring_of_positions(t, dimensions)), lambda r: r.isNotNull())

    found = F.filter(F.transform(polygons, built), lambda p: F.size(p) > 0)
    return F.when(F.size(found) > 0, found)


def first_value(xml: Column, name: str) -> Column:
    """The text of a feature's first element of this name, at any depth; null if there is none or nothing in it.

    Cut out by its tags. Only where that may not be the text (a reference, a comment, a section of characters, elements
    inside) the feature is parsed: a parse takes a millisecond, and each name asks for one."""
    leaf = F.regexp_substr(xml, F.lit(rf"<{name}(?:\s[^<>]*)?(?:/>|>[^<]*</{name}\s*>)"))
    odd = xml.rlike(r"&|<[!?]") | (leaf.isNull() & xml.rlike(rf"<{name}[\s/>]"))
    return F.nullif(F.when(odd, F.xpath_string(xml, F.lit(f"//{name}"))).otherwise(F.regexp_replace(leaf, "<[^>]*>", "")), F.lit(""))


def with_surface(rows: DataFrame, *columns: Column, dimensions: int = 2) -> DataFrame:
    """These columns and the geometry of each feature that has one. As a generator, so that the optimizer does not copy the
    geometry into the filter and read it twice."""
    return rows.select(*columns, F.explode(F.array(surface_geometry(F.col("feature_xml"), dimensions))).alias("geometry")).where("geometry IS NOT NULL")


def cadastral(pages: DataFrame) -> DataFrame:
    """Cadastral parcels; a feature without number or geometry is no row (number 0 counts as none)."""
    rows = open_features(pages, "SamletFastEjendom_Gaeldende")
    fields = [convert(first_value(F.col("feature_xml"), src)).alias(dst) for src, dst, convert in CADASTRAL_FIELDS]
    return with_surface(rows, F.col("path"), F.col("pos"), *fields, dimensions=3).where("bfe_number <> 0")


def water_projects(pages: DataFrame, layer: str) -> DataFrame:
    """Water projects of one layer: typed fields, the others in a map, area in hectares."""
    rows = with_surface(open_features(pages, layer), F.col("path"), F.col("pos"), open_fields(F.col("feature_xml"), "the_geom").alias("fields"))
    typed = [convert(F.try_element_at("fields", F.lit(k))).alias(k) for k, convert in WATER_FIELDS.items()]
    return rows.select(F.lit(layer).alias("layer_name"), "path", "pos", *typed, G.hectares(F.col("geometry")).alias("area_ha"), "fields", "geometry")


def protected_areas(pages: DataFrame, layer: str) -> DataFrame:
    """Protected areas around wells: area in hectares, status and its category, the other fields in a map. A feature without
    a geometry is no row; one without a status has no category."""
    rows = with_surface(open_features(pages, layer), F.col("path"), F.col("pos"), open_fields(F.col("feature_xml"), "Shape").alias("fields"))
    status = F.try_element_at("fields", F.lit("status_bnbo"))
    return rows.select(
        "path", "pos", G.hectares(F.col("geometry")).alias("area_ha"), status.alias("status_bnbo"), status_category(status, PROTECTION_STATUS).alias("status_category"), "fields", "geometry"
    )


def wetland_cells(pages: DataFrame, row: str = "kulstof2022") -> DataFrame:
    xml = F.col("feature_xml")
    return with_surface(
        open_features(pages, row),
        F.regexp_extract(xml, r'\sid="([^"]*)"', 1).alias("id"),
        to_int(first_value(xml, "gridcode")).cast("int").alias("gridcode"),
        clean_text(first_value(xml, "toerv_pct")).alias("toerv_pct"),
    )
