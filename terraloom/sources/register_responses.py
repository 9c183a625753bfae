"""Landed responses of the livestock and medicine registers: JSON lines with a declared shape, and typed rows out of them.

Responses are parsed as VARIANT and shaped node by node (`shaped`), as services do not keep to one form: a list of one
comes as that record, and a list may be inside an element that has it as its only child. Every leaf is read as text and
converted by its declaration, so a response with a leaf of another kind loses that leaf alone. Absent parts are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from terraloom.functions import geometry as G
from terraloom.functions.clean import clean_text, person_id, positive, to_float, to_int, yes_flag
from terraloom.functions.crs import checked_point
from terraloom.operators.dedupe import first_seen
from terraloom.operators.livestock import not_total
from terraloom.operators.mapping import Converter

Fields = Sequence[tuple[str, str, Converter]]


def number(c: Column) -> Column:
    """A whole number; null for 0 too."""
    return positive(to_int(c))


def day(c: Column) -> Column:
    """The day of a date or time as text, YYYY-MM-DD."""
    return F.date_format(F.try_to_timestamp(clean_text(c)), "yyyy-MM-dd")


#: The registers' element names and the columns they become.
PROPERTY_FIELDS: Fields = (
    ("Ejendom.Adresse", "property_address", clean_text),
    ("Ejendom.ByNavn", "property_city", clean_text),
    ("Ejendom.PostNummer", "property_postal_code", clean_text),
    ("Ejendom.PostDistrikt", "property_postal_district", clean_text),
    ("Ejendom.KommuneNummer", "property_municipality_code", number),
    ("Ejendom.KommuneNavn", "property_municipality_name", clean_text),
    ("Ejendom.DatoOpret", "property_created_date", day),
    ("Ejendom.DatoOpdatering", "property_updated_date", day),
    ("FVST.FoedevareRegionsNummer", "food_region_number", number),
    ("FVST.FoedevareRegionsNavn", "food_region_name", clean_text),
    ("FVST.VeterinaerAfdelingsNavn", "veterinary_dept_name", clean_text),
    ("FVST.VeterinaerSektionsNavn", "veterinary_section_name", clean_text),
    ("VeterinaereHaendelser.VeterinaereProblemer", "veterinary_problems", clean_text),
)
EVENT_FIELDS: Fields = (
    ("SygdomsKode", "disease_code", clean_text),
    ("SygdomsTekst", "disease_text", clean_text),
    ("VeterinaerStatusKode", "status_code", clean_text),
    ("VeterinaerStatusTekst", "status_text", clean_text),
    ("SygdomsNiveauKode", "level_code", clean_text),
    ("SygdomsNiveauTekst", "level_text", clean_text),
    ("DatoVeterinaerStatus", "status_date", day),
    ("VeterinaerHaendelseBemaerkning", "remarks", clean_text),
)
HERD_FIELDS: Fields = (
    ("BesaetningsNummer", "herd_number", number),
    ("DyreArtKode", "species_code", number),
    ("DyreArtTekst", "species_text", clean_text),
    ("BrugsArtKode", "usage_code", number),
    ("BrugsArtTekst", "usage_text", clean_text),
    ("VirksomhedsArtTekst", "business_type", clean_text),
    ("VirksomhedsArtKode", "business_type_code", number),
    ("BesaetningsTypeTekst", "herd_type", clean_text),
    ("BesaetningsTypeKode", "herd_type_code", number),
    ("OmsaetningsTekst", "trade_text", clean_text),
    ("OmsaetningsKode", "trade_code", number),
    ("Oekologisk", "is_organic", yes_flag),
    ("BesaetningsStatus", "herd_status", clean_text),
    ("DatoOpret", "creation_date", day),
    ("DatoOpdatering", "last_update", day),
    ("DatoOphoer", "end_date", day),
    ("BesStrDatoAjourfoert", "last_size_update", day),
)
SIZE_FIELDS: Fields = (("BesaetningsStoerrelseTekst", "animal_type", clean_text), ("BesaetningsStoerrelse", "count", to_int))
PERSON_FIELDS: Fields = (
    ("CvrNummer", "cvr_number", clean_text),
    ("CprNummer", "cpr_number", clean_text),
    ("Navn", "name", clean_text),
    ("Adresse", "address", clean_text),
    ("ByNavn", "city", clean_text),
    ("PostNummer", "postal_code", clean_text),
    ("PostDistrikt", "postal_district", clean_text),
    ("KommuneNummer", "municipality_code", number),
    ("KommuneNavn", "municipality_name", clean_text),
    ("TelefonNummer", "phone", clean_text),
    ("MobilNummer", "mobile", clean_text),
    ("Email", "email", clean_text),
    ("Adressebeskyttelse", "address_protection", yes_flag),
    ("Reklamebeskyttelse", "advertising_protection", yes_flag),
)
PRACTICE_FIELDS: Fields = (
    ("PraksisNr", "practice_number", number),
    ("PraksisNavn", "name", clean_text),
    ("PraksisAdresse", "address", clean_text),
    ("PraksisByNavn", "city", clean_text),
    ("PraksisPostNummer", "postal_code", clean_text),
    ("PraksisPostDistrikt", "postal_district", clean_text),
    ("PraksisTelefonNummer", "phone", clean_text),
    ("PraksisMobilNummer", "mobile", clean_text),
    ("PraksisEmail", "email", clean_text),
)
DECLARATION_FIELDS: Fields = (
    ("ChrNummerAfsender", "sender_chr_number", number),
    ("BesaetningsNummerAfsender", "sender_herd_number", number),
    ("ChrNummerModtager", "receiver_chr_number", number),
    ("BesaetningsNummerModtager", "receiver_herd_number", number),
    ("EgenProduktion", "own_production", yes_flag),
    ("KunAvlsdyr", "breeding_only", yes_flag),
    ("IndgaarIGruppevisLevering", "group_delivery", yes_flag),
    ("DatoStart", "start_date", day),
    ("DatoSlut", "end_date", day),
)
ANTIBIOTIC_FIELDS: Fields = (
    ("Aar", "year", to_int),
    ("Maaned", "month", to_int),
    ("DyreArtKode", "species_code", to_int),
    ("DyreArtTekst", "species_text", clean_text),
    ("Aldersgruppekode", "age_group_code", to_int),
    ("Aldersgruppe", "age_group", clean_text),
    ("Rul9MdrGns", "rolling_9m_avg", to_float),
    ("Rul12MdrGns", "rolling_12m_avg", to_float),
    ("CVRNummer", "cvr_number", clean_text),
    ("Kommunenr", "municipality_code", to_int),
    ("Kommunenavn", "municipality_name", clean_text),
    ("Regionsnr", "region_code", to_int),
    ("Regionsnavn", "region_name", clean_text),
    ("Dyredage", "animal_days", to_int),
    ("Dyredoser", "animal_doses", to_float),
    ("ADDPer100DyrPerDag", "add_per_100_animals_per_day", to_float),
    ("Graensevaerdi", "threshold_value", to_float),
)
USAGE_FIELDS: Fields = (
    ("DyreArtKode", "species_code", to_int),
    ("DyreArtTekst", "species_text", clean_text),
    ("BrugsArtKode", "usage_code", to_int),
    ("BrugsArtTekst", "usage_text", clean_text),
)
LISTED_HERD_FIELDS: Fields = (
    ("BesaetningsNummer", "herd_number", to_int),
    ("DyreArtKode", "species_code", to_int),
    ("BrugsArtKode", "usage_code", to_int),
    ("CHKNummer", "chk_number", clean_text),
    ("Status", "status", clean_text),
)


def _struct(*parts: str) -> str:
    return f"struct<{','.join(parts)}>"


def _leaves(fields: Fields, below: str = "") -> list[str]:
    names = (src.removeprefix(below) for src, _, _ in fields if src.startswith(below))
    return [f"{n}:string" for n in names if "." not in n]


def _ddl(kind: str) -> str:
    return kind.removeprefix("struct<").removesuffix(">") if kind.startswith("struct<") else kind


def only(kind: str, *names: str) -> str:
    """A kind with these of its fields alone, for readers that need no more: each leaf of a kind is looked up in each record."""
    parts: list[str] = [""]
    depth = 0
    for c in _ddl(kind):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append("")
        else:
            parts[-1] += c
    types = dict(p.split(":", 1) for p in parts)
    return _struct(*(f"{n}:{types[n]}" for n in names))


HERD = _struct(
    *_leaves(HERD_FIELDS), "ChrNummer:string", f"BesStr:array<{_struct(*_leaves(SIZE_FIELDS))}>", f"Ejer:{_struct(*_leaves(PERSON_FIELDS))}", f"Bruger:{_struct(*_leaves(PERSON_FIELDS))}",
    f"BesPraksis:{_struct(*_leaves(PRACTICE_FIELDS))}", f"LeveringsErklaeringer:array<{_struct(*_leaves(DECLARATION_FIELDS))}>",
)
PROPERTY = _struct(
    "ChrNummer:string",
    f"Ejendom:{_struct(*_leaves(PROPERTY_FIELDS, 'Ejendom.'))}",
    f"FVST:{_struct(*_leaves(PROPERTY_FIELDS, 'FVST.'))}",
    "StaldKoordinater:struct<StaldKoordinatX:string,StaldKoordinatY:string>",
    f"VeterinaereHaendelser:struct<VeterinaereProblemer:string,VeterinaerHaendelse:array<{_struct(*_leaves(EVENT_FIELDS))}>>",
    "SamdriftNaboaftaler:array<struct<DyreArtKode:string,DyreArtTekst:string,ChrNumre:array<string>>>",
    f"Besaetninger:array<{HERD}>",
)
ANTIBIOTICS = f"chr_number:string,period_from:string,period_to:string,Data:array<{_struct(*_leaves(ANTIBIOTIC_FIELDS))}>"
USAGE = "DyreArtKode:string,DyreArtTekst:string,BrugsArtKode:string,BrugsArtTekst:string"
HERD_LIST = "DyreArtKode:string,BrugsArtKode:string,FraNummer:string,BesNrListe:array<string>"


#: What a reader of herds, of sizes with a herd's own columns, needs; and what one of properties without their herds does.
HERD_ROWS = only(HERD, "ChrNummer", *(n for n, _, _ in HERD_FIELDS), "BesStr")
PROPERTY_ROWS = only(PROPERTY, "ChrNummer", "Ejendom", "FVST", "StaldKoordinater", "VeterinaereHaendelser", "SamdriftNaboaftaler")
PROPERTY_HERDS = _struct("ChrNummer:string", f"Besaetninger:array<{HERD_ROWS}>")
_OF_HERD = ("ChrNummer", "BesaetningsNummer")
OWNERS, PEOPLE, PRACTICES, DECLARATIONS = only(HERD, *_OF_HERD, "Ejer"), only(HERD, *_OF_HERD, "Ejer", "Bruger"), only(HERD, *_OF_HERD, "BesPraksis"), only(HERD, "ChrNummer", "LeveringsErklaeringer")

#: Lists that may be the only child of an element of this name.
WRAPPED = {"Besaetninger": "Besaetning", "LeveringsErklaeringer": "LeveringsErklaering", "SamdriftNaboaftaler": "Samdrift", "ChrNumre": "ChrNummer"}
#: The place of a record: its file, the split of the file, the line's number in the split, and its place in the line. In this
#: order records are as they came.
PLACE = ("page", "block", "pos", "item")


def _nothing(node: Column) -> Column:
    return node.isNull() | F.is_variant_null(node)


def as_lists(node: Column, inner: str | None = None) -> Column:
    """The records of a VARIANT node as an array: of a list its items, of a single record that alone, of an element that has the
    list as its child `inner` what that holds; null where there is none or nothing in it."""
    if inner:
        node = F.coalesce(F.try_variant_get(node, f"$.{inner}", "variant"), node)
    empty = _nothing(node) | (F.coalesce(F.size(F.try_variant_get(node, "$", "map<string,variant>")), F.lit(-1)) == 0)
    return F.coalesce(F.try_variant_get(node, "$", "array<variant>"), F.when(~empty, F.array(node)))


def _of_leaves(kind: DataType) -> bool:
    return isinstance(kind, StructType) and all(isinstance(f.dataType, StringType) for f in kind.fields)


def shaped(node: Column, kind: DataType, path: str = "$", name: str = "") -> Column:
    """A VARIANT's node in a declared shape: structs by the names of their fields, lists as in `as_lists`, leaves as text. What is
    not there, or of another kind, is null; the rest of the record stays.

    A record of leaves, and a list of such records that came as one, are read in one cast, which gives each leaf as the
    lookup of it does; only what the cast does not know is shaped node by node."""
    if isinstance(kind, ArrayType):
        each = F.transform(as_lists(F.try_variant_get(node, path, "variant"), WRAPPED.get(name)), lambda x: shaped(x, kind.elementType))
        if not _of_leaves(kind.elementType):
            return each
        whole = F.try_variant_get(node, path, kind.simpleString())
        return F.coalesce(G.let(whole, lambda w: F.when(~F.exists(w, lambda x: x.isNull()), w)), each)
    if isinstance(kind, StructType):
        fields = F.struct(*(shaped(node, f.dataType, f"{path}.{f.name}", f.name).alias(f.name) for f in kind.fields))
        each = F.when(~_nothing(F.try_variant_get(node, path, "variant")), fields)
        return F.coalesce(F.try_variant_get(node, path, kind.simpleString()), each) if _of_leaves(kind) else each
    return F.try_variant_get(node, path, "string")


def responses(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Landed responses with their PLACE. A line holds one response or a list of them; an unreadable line is one without values."""
    rows = spark.read.text(path).where("trim(value) <> ''")
    rows = rows.select(F.col("_metadata.file_path").alias("page"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.try_parse_json("value").alias("v"))
    each = rows.select("page", "block", "pos", F.posexplode(F.coalesce(as_lists(F.col("v")), F.array(F.lit(None).cast("variant")))).alias("item", "v"))
    fields = F.struct(*(shaped(F.col("v"), f.dataType, f"$.{f.name}", f.name).alias(f.name) for f in StructType.fromDDL(_ddl(kind)).fields))
    # As a generator, so that the optimizer does not copy a record's shape into each expression that reads a leaf of it.
    return each.select(*PLACE, F.inline(F.array(fields)))


def typed(source: str, fields: Fields) -> list[Column]:
    """The columns of a struct's declared fields; all null where the struct is."""
    return [convert(F.col(f"{source}.{src}" if source else src)).alias(dst) for src, dst, convert in fields]


def properties(given: DataFrame) -> DataFrame:
    """One row a property response: address, municipality and food authority, the stable's place in degrees where it is
    inside the country's bounds, its events and agreements as lists. A property without a number is no row."""
    x, y = (to_float(F.col(f"StaldKoordinater.StaldKoordinat{c}")) for c in "XY")
    place = checked_point(x, y)
    events = F.transform("VeterinaereHaendelser.VeterinaerHaendelse", lambda e: F.struct(*(convert(e[src]).alias(dst) for src, dst, convert in EVENT_FIELDS)))
    members = lambda a: F.filter(F.transform(a["ChrNumre"], number), lambda n: n.isNotNull())
    agreements = F.transform("SamdriftNaboaftaler", lambda a: F.struct(number(a["DyreArtKode"]).alias("species_code"), clean_text(a["DyreArtTekst"]).alias("species_text"), members(a).alias("chr_numbers")))
    return given.select(
        number(F.col("ChrNummer")).alias("chr_number"), *typed("", PROPERTY_FIELDS), F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y"))).alias("stable_coordinates_utm32"),
        place["y"].alias("latitude"), place["x"].alias("longitude"), events.alias("veterinary_events"), agreements.alias("cooperation_agreements"),
    ).where("chr_number IS NOT NULL")


def events(given: DataFrame) -> DataFrame:
    """One row an event of a property."""
    return properties(given).select("chr_number", F.explode("veterinary_events").alias("e")).select("chr_number", "e.*")


def agreements(given: DataFrame) -> DataFrame:
    """One row a member of a property's cooperation agreements; a member without a number is none."""
    each = properties(given).select("chr_number", F.explode("cooperation_agreements").alias("a"))
    return each.select("chr_number", "a.species_code", F.explode("a.chr_numbers").alias("member"))


def herds_of(given: DataFrame) -> DataFrame:
    """(PLACE, nth, chr_number, herd) of each herd in property responses; `nth` is its place among the property's."""
    return given.select(*PLACE, number(F.col("ChrNummer")).alias("chr_number"), F.posexplode("Besaetninger").alias("nth", "herd"))


def herd_rows(herds: DataFrame) -> DataFrame:
    """A row a herd and size that is no total, with all herd columns; a herd without sizes keeps one row."""
    sizes = F.filter("herd.BesStr", lambda s: not_total(s["BesaetningsStoerrelseTekst"]))
    return herds.select("chr_number", *typed("herd", HERD_FIELDS), F.explode_outer(sizes).alias("size")).select("*", *typed("size", SIZE_FIELDS)).drop("size")


def herd_masters(given: DataFrame) -> DataFrame:
    """Herd master responses (the herd itself at the top) in the form of `herds_of`, for `herd_rows`, `persons` and the others."""
    leaves = F.struct(*(c for c in given.columns if c not in PLACE))
    return given.select(*PLACE, F.lit(0).alias("nth"), number(F.col("ChrNummer")).alias("chr_number"), leaves.alias("herd"))


def persons(herds: DataFrame, source: str, role: str) -> DataFrame:
    """Owners (Ejer) or users (Bruger) with all their columns; without a company and a person number there is no row."""
    return _persons(herds, source, role).drop(*PLACE, "nth")


def _persons(herds: DataFrame, source: str, role: str) -> DataFrame:
    out = herds.select(*PLACE, "nth", "chr_number", number(F.col("herd.BesaetningsNummer")).alias("herd_number"), F.lit(role).alias("role"), *typed(f"herd.{source}", PERSON_FIELDS))
    return out.where("cvr_number IS NOT NULL OR cpr_number IS NOT NULL")


def first_persons(herds: DataFrame, source: str, role: str) -> DataFrame:
    """`persons`, once a person (company number, else person number), property and herd: the row that came first, whole."""
    rows = _persons(herds, source, role).withColumn("person", person_id(F.col("cvr_number"), F.col("cpr_number")))
    return first_seen(rows, ["person", "chr_number", "herd_number"], [*PLACE, "nth"]).drop(*PLACE, "nth", "person")


def practices(herds: DataFrame) -> DataFrame:
    """Veterinary practices with all their columns; without a number there is no row."""
    return _practices(herds).drop(*PLACE, "nth")


def _practices(herds: DataFrame) -> DataFrame:
    out = herds.select(*PLACE, "nth", "chr_number", number(F.col("herd.BesaetningsNummer")).alias("herd_number"), *typed("herd.BesPraksis", PRACTICE_FIELDS))
    return out.where("practice_number IS NOT NULL")


def first_practices(herds: DataFrame) -> DataFrame:
    """`practices`, once a practice, property and herd: the row that came first, whole."""
    return first_seen(_practices(herds), ["practice_number", "chr_number", "herd_number"], [*PLACE, "nth"]).drop(*PLACE, "nth")


def first_properties(given: DataFrame) -> DataFrame:
    """Property responses, once a number: the one that came first."""
    keyed = given.withColumn("chr", number(F.col("ChrNummer"))).where("chr IS NOT NULL")
    return first_seen(keyed, ["chr"], list(PLACE)).drop("chr")


def usages(given: DataFrame) -> DataFrame:
    """(species_code, species_text, usage_code, usage_text) of responses that list species with their usages; without both codes
    as whole numbers there is no row."""
    return given.select(*typed("", USAGE_FIELDS)).where("species_code IS NOT NULL AND usage_code IS NOT NULL")


def declarations(herds: DataFrame) -> DataFrame:
    """One row a delivery declaration."""
    return herds.select(F.explode("herd.LeveringsErklaeringer").alias("d")).select(*typed("d", DECLARATION_FIELDS))


def antibiotics(given: DataFrame) -> DataFrame:
    """One row a month's entry of a medicine response: its typed leaves, the number that was asked for and the period."""
    # What a response has once is converted before it is repeated for each entry.
    once = given.select(to_int(F.col("chr_number")).alias("chr_number"), day(F.col("period_from")).alias("period_from"), day(F.col("period_to")).alias("period_to"), "Data")
    each = once.select("chr_number", "period_from", "period_to", F.explode("Data").alias("d"))
    return each.select("chr_number", *typed("d", ANTIBIOTIC_FIELDS), "period_from", "period_to")


def herd_numbers(given: DataFrame) -> DataFrame:
    """Herd numbers of cursor pages: positive whole numbers, each once with its codes. Pages overlap at their ends."""
    each = given.select(F.explode("BesNrListe").alias("n"), to_int(F.col("DyreArtKode")).alias("species_code"), to_int(F.col("BrugsArtKode")).alias("usage_code"))
    return each.select(to_int(F.col("n")).alias("herd_number"), "species_code", "usage_code").where("herd_number > 0").distinct()


def last_cursors(given: DataFrame) -> DataFrame:
    """The next cursor of each combination of codes: one more than the largest number seen, null once a page brought no
    number that was not there before it."""
    each = given.select("DyreArtKode", "BrugsArtKode", to_int(F.col("FraNummer")).alias("start"), F.array_max(F.transform("BesNrListe", to_int)).alias("top"))
    seen = each.groupBy("DyreArtKode", "BrugsArtKode").agg(F.max("top").alias("top"), F.max("start").alias("start"))
    return seen.select(to_int(F.col("DyreArtKode")).alias("species_code"), to_int(F.col("BrugsArtKode")).alias("usage_code"), F.when(F.col("top") >= F.col("start"), F.col("top") + 1).alias("next"))


def listed_herds(given: DataFrame) -> DataFrame:
    return given.select(*typed("", LISTED_HERD_FIELDS))
