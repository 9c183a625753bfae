"""Queries of the livestock and medicine registers: the given tables are written as landed responses and read by the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.plans.registry import registry
from terraloom.session import prepare, read, shared_dir
from terraloom.sources import register_responses as R

QUERIES, ORACLES, query = registry()


def landed(spark: SparkSession, df: DataFrame) -> str:
    """`df` as JSON lines in a folder of its own; null leaves are absent."""
    path = f"{shared_dir(prepare(spark))}/landed-{uuid.uuid4().hex[:12]}"
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)
    return path


def _person(k: Column) -> Column:
    return F.struct(
        F.when(k % 3 == 0, " ").otherwise((F.col("o_custkey") % 50).cast("string")).alias("CvrNummer"), F.when(k % 6 != 0, F.concat(F.lit("p"), F.col("o_custkey") % 20)).alias("CprNummer"),
        F.concat(F.lit(" n"), k).alias("Navn"), F.concat(F.lit("Vej "), k % 9).alias("Adresse"), F.lit("By").alias("ByNavn"), F.format_string("%04d", (k % 9999).cast("int")).alias("PostNummer"),
        (k % 4).cast("string").alias("KommuneNummer"), F.concat(F.lit("+45 "), k).alias("TelefonNummer"), F.when(k % 2 == 0, "Ja").otherwise("Nej").alias("Adressebeskyttelse"),
    )


def _herds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, herd): an order as a herd, with two sizes, people, a practice and a declaration."""
    k = F.col("o_orderkey")
    herd = F.struct(
        F.col("o_custkey").cast("string").alias("ChrNummer"), (k % 40).cast("string").alias("BesaetningsNummer"), F.lit("15").alias("DyreArtKode"), F.lit(" Svin ").alias("DyreArtTekst"), (k % 3).cast("string").alias("BrugsArtKode"),
        F.col("o_orderpriority").alias("VirksomhedsArtTekst"), (k % 2).cast("string").alias("VirksomhedsArtKode"), F.when(k % 4 == 0, "Ja").alias("Oekologisk"), F.col("o_orderstatus").alias("BesaetningsStatus"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("DatoOpret"),
        F.array(F.struct(F.when(k % 7 == 1, "I alt").otherwise(F.concat(F.lit("dyr "), k % 5)).alias("BesaetningsStoerrelseTekst"), (k % 100).cast("string").alias("BesaetningsStoerrelse")), F.struct(F.lit("i ALT alle").alias("BesaetningsStoerrelseTekst"), F.lit("9").alias("BesaetningsStoerrelse"))).alias("BesStr"),
        _person(k).alias("Ejer"), F.when(k % 2 == 0, _person(k)).alias("Bruger"),
        F.struct(F.when(k % 5 != 0, (k % 11).cast("string")).alias("PraksisNr"), F.lit(" Praksis ").alias("PraksisNavn"), F.concat(F.lit("dyr"), k, F.lit("@x.example")).alias("PraksisEmail")).alias("BesPraksis"),
        F.array(F.struct(F.col("o_custkey").cast("string").alias("ChrNummerAfsender"), (k % 13).cast("string").alias("ChrNummerModtager"), F.when(k % 4 == 1, "Ja").alias("EgenProduktion"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("DatoStart"))).alias("LeveringsErklaeringer"),
    )
    return read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", herd.alias("herd"))


def _properties(spark: SparkSession, sf_dir: str, kind: str = R.PROPERTY) -> DataFrame:
    """A customer as a property response with its orders as herds; every seventh without herds, events or a place."""
    herds = _herds(spark, sf_dir).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "herd"))).alias("h"))
    k = F.col("c_custkey")
    out = read(spark, sf_dir, "customer").join(herds, "c_custkey", "left").select(
        k.cast("string").alias("ChrNummer"),
        F.struct(F.concat(F.lit(" "), F.col("c_name")).alias("Adresse"), F.col("c_mktsegment").alias("ByNavn"), F.col("c_nationkey").cast("string").alias("KommuneNummer"), F.lit("2020-02-30").alias("DatoOpret"), F.lit("2021-03-04T05:06:07").alias("DatoOpdatering")).alias("Ejendom"),
        F.when(k % 7 != 0, F.struct((k % 3).cast("string").alias("FoedevareRegionsNummer"), F.lit("").alias("FoedevareRegionsNavn"))).alias("FVST"),
        F.when(k % 7 != 0, F.struct((F.lit(550000) + k % 1000).cast("string").alias("StaldKoordinatX"), F.when(k % 7 == 1, "0").otherwise((F.lit(6200000) + k % 1000).cast("string")).alias("StaldKoordinatY"))).alias("StaldKoordinater"),
        F.when(k % 7 != 0, F.struct(F.lit("Nej").alias("VeterinaereProblemer"), F.transform(F.sequence(F.lit(1), (k % 3 + 1).cast("int")), lambda i: F.struct(F.concat(F.lit("S"), i).alias("SygdomsKode"), F.lit("2022-01-02").alias("DatoVeterinaerStatus"))).alias("VeterinaerHaendelse"))).alias("VeterinaereHaendelser"),
        F.when(k % 2 == 0, F.array(F.struct(F.lit("15").alias("DyreArtKode"), F.array((k + 1).cast("string"), F.lit("0"), F.lit("x"), (k + 2).cast("string")).alias("ChrNumre")))).alias("SamdriftNaboaftaler"),
        F.transform("h", lambda x: x["herd"]).alias("Besaetninger"),
    )
    return R.responses(spark, landed(spark, out), kind)


@query("""
    SELECT c_custkey AS chr_number, trim(c_name) AS property_address, c_mktsegment AS property_city, nullif(c_nationkey, 0)::BIGINT AS property_municipality_code, CAST(NULL AS VARCHAR) AS property_created_date,
           '2021-03-04' AS property_updated_date, CASE WHEN c_custkey % 7 <> 0 THEN nullif(c_custkey % 3, 0) END AS food_region_number, CAST(NULL AS VARCHAR) AS food_region_name,
           CASE WHEN c_custkey % 7 <> 0 THEN (550000 + c_custkey % 1000)::DOUBLE END AS x, c_custkey % 7 > 1 AS placed, (CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey % 3 + 1 END)::INTEGER AS events
    FROM customer WHERE c_custkey <> 0""")
def property_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = R.properties(_properties(spark, sf_dir, R.PROPERTY_ROWS))
    return p.select(
        "chr_number", "property_address", "property_city", "property_municipality_code", "property_created_date", "property_updated_date", "food_region_number", "food_region_name",
        F.col("stable_coordinates_utm32.x").alias("x"), F.col("latitude").isNotNull().alias("placed"), F.coalesce(F.size("veterinary_events"), F.lit(0)).alias("events"),
    )


@query("SELECT c_custkey AS chr_number, 'S' || i AS disease_code, '2022-01-02' AS status_date FROM (SELECT c_custkey, unnest(range(1, c_custkey % 3 + 2)) AS i FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey <> 0)")
def veterinary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.events(_properties(spark, sf_dir, R.PROPERTY_ROWS)).select("chr_number", "disease_code", "status_date")


@query("SELECT c_custkey AS chr_number, 15::BIGINT AS species_code, c_custkey + i AS member FROM customer, (SELECT unnest([1, 2]) AS i) WHERE c_custkey % 2 = 0 AND c_custkey <> 0")
def agreement_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.agreements(_properties(spark, sf_dir, R.PROPERTY_ROWS))


_HERD = """nullif(o_custkey, 0) AS chr_number, nullif(o_orderkey % 40, 0) AS herd_number, 15::BIGINT AS species_code, 'Svin' AS species_text, nullif(o_orderkey % 3, 0) AS usage_code, CAST(NULL AS VARCHAR) AS usage_text,
    o_orderpriority AS business_type, nullif(o_orderkey % 2, 0) AS business_type_code, CAST(NULL AS VARCHAR) AS herd_type, CAST(NULL AS BIGINT) AS herd_type_code, CAST(NULL AS VARCHAR) AS trade_text,
    CAST(NULL AS BIGINT) AS trade_code, CAST(o_orderkey % 4 = 0 AS INTEGER) AS is_organic, o_orderstatus AS herd_status, strftime(o_orderdate, '%Y-%m-%d') AS creation_date, CAST(NULL AS VARCHAR) AS last_update,
    CAST(NULL AS VARCHAR) AS end_date, CAST(NULL AS VARCHAR) AS last_size_update, CASE WHEN o_orderkey % 7 <> 1 THEN 'dyr ' || (o_orderkey % 5) END AS animal_type, CASE WHEN o_orderkey % 7 <> 1 THEN o_orderkey % 100 END AS count"""


@query(f"SELECT {_HERD} FROM orders")
def herd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All herd columns of herd master responses, a row a size that is no total."""
    masters = R.responses(spark, landed(spark, _herds(spark, sf_dir).select("herd.*")), R.HERD_ROWS)
    return R.herd_rows(R.herd_masters(masters))


@query(f"SELECT {_HERD} FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def property_herds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same out of property responses."""
    return R.herd_rows(R.herds_of(_properties(spark, sf_dir, R.PROPERTY_HERDS)))


_PERSON = """SELECT nullif(o_custkey, 0) AS chr_number, nullif(o_orderkey % 40, 0) AS herd_number, {role} AS role, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey % 50 AS VARCHAR) END AS cvr_number,
    CASE WHEN o_orderkey % 6 <> 0 THEN 'p' || (o_custkey % 20) END AS cpr_number, 'n' || o_orderkey AS name, 'Vej ' || (o_orderkey % 9) AS address, 'By' AS city, printf('%04d', o_orderkey % 9999) AS postal_code,
    CAST(NULL AS VARCHAR) AS postal_district, nullif(o_orderkey % 4, 0) AS municipality_code, CAST(NULL AS VARCHAR) AS municipality_name, '+45 ' || o_orderkey AS phone, CAST(NULL AS VARCHAR) AS mobile,
    CAST(NULL AS VARCHAR) AS email, CAST(o_orderkey % 2 = 0 AS INTEGER) AS address_protection, CAST(0 AS INTEGER) AS advertising_protection FROM orders WHERE o_orderkey % 6 <> 0 """


@query(_PERSON.format(role="'owner'") + "UNION ALL " + _PERSON.format(role="'user'") + "AND o_orderkey % 2 = 0")
def person_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners and users with all their columns."""
    herds = R.herd_masters(R.responses(spark, landed(spark, _herds(spark, sf_dir).select("herd.*")), R.PEOPLE))
    return R.persons(herds, "Ejer", "owner").unionByName(R.persons(herds, "Bruger", "user"))


@query("""
    SELECT nullif(o_custkey, 0) AS chr_number, nullif(o_orderkey % 40, 0) AS herd_number, o_orderkey % 11 AS practice_number, 'Praksis' AS name, 'dyr' || o_orderkey || '@x.example' AS email
    FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0""")
def practice_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    herds = R.herd_masters(R.responses(spark, landed(spark, _herds(spark, sf_dir).select("herd.*")), R.PRACTICES))
    return R.practices(herds).select("chr_number", "herd_number", "practice_number", "name", "email")


@query("""
    SELECT nullif(o_custkey, 0) AS sender_chr_number, CAST(NULL AS BIGINT) AS sender_herd_number, nullif(o_orderkey % 13, 0) AS receiver_chr_number, CAST(NULL AS BIGINT) AS receiver_herd_number,
           CAST(o_orderkey % 4 = 1 AS INTEGER) AS own_production, 0::INTEGER AS breeding_only, 0::INTEGER AS group_delivery, strftime(o_orderdate, '%Y-%m-%d') AS start_date, CAST(NULL AS VARCHAR) AS end_date FROM orders""")
def declaration_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.declarations(R.herd_masters(R.responses(spark, landed(spark, _herds(spark, sf_dir).select("herd.*")), R.DECLARATIONS)))


@query("""
    SELECT l_orderkey AS chr_number, year(l_shipdate) AS year, month(l_shipdate) AS month, l_linenumber::BIGINT AS species_code, l_returnflag AS species_text, round(l_tax * 100, 2) AS rolling_9m_avg,
           CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS animal_days, l_quantity + 0.5 AS animal_doses, CAST(NULL AS VARCHAR) AS cvr_number, '2024-01-01' AS period_from, '2024-12-31' AS period_to FROM lineitem""")
def antibiotic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as the months of a medicine response, numbers with a comma, days that may be unreadable."""
    d = F.struct(
        F.year("l_shipdate").cast("string").alias("Aar"), F.month("l_shipdate").cast("string").alias("Maaned"), F.col("l_linenumber").cast("string").alias("DyreArtKode"), F.concat(F.lit(" "), F.col("l_returnflag")).alias("DyreArtTekst"),
        F.round(F.col("l_tax") * 100, 2).cast("string").alias("Rul9MdrGns"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey").cast("string")).otherwise("12.5").alias("Dyredage"),
        F.concat(F.col("l_quantity").cast("long"), F.lit(",5")).alias("Dyredoser"), F.lit("  ").alias("CVRNummer"),
    )
    pages = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("chr_number")).agg(F.collect_list(d).alias("Data"))
    pages = pages.withColumns({"period_from": F.lit("2024-01-01"), "period_to": F.lit("2024-12-31")})
    out = R.antibiotics(R.responses(spark, landed(spark, pages), R.ANTIBIOTICS))
    return out.select("chr_number", "year", "month", "species_code", "species_text", F.round("rolling_9m_avg", 2).alias("rolling_9m_avg"), "animal_days", "animal_doses", "cvr_number", "period_from", "period_to").withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


def _varied(k: Column, items: Column, inner: str | None = None) -> Column:
    """A list in one of the forms in which services send it, by k: as it is or inside an element, and a list of one as that record
    or as a list."""
    whole = F.to_variant_object(items)
    node = F.when((F.size(items) == 1) & (k % 2 == 1), F.variant_get(whole, "$[0]", "variant")).when(items.isNotNull(), whole)
    if not inner:
        return node
    return F.when((k % 3 == 1) & items.isNotNull(), F.to_variant_object(F.struct(node.alias(inner)))).otherwise(node)


def _mixed_herds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`_herds` with sizes and declarations in varied forms; where the first size is no total the other, which is one, is left out."""
    k = F.col("o_orderkey")
    sizes = F.when(k % 7 == 1, F.col("herd.BesStr")).otherwise(F.slice("herd.BesStr", 1, 1))
    herd = F.col("herd").withField("BesStr", _varied(k, sizes)).withField("LeveringsErklaeringer", _varied(k + 1, F.col("herd.LeveringsErklaeringer"), "LeveringsErklaering"))
    return _herds(spark, sf_dir).select("o_custkey", "o_orderkey", herd.alias("herd"))


def _mixed_masters(spark: SparkSession, sf_dir: str, kind: str = R.HERD) -> DataFrame:
    """Herd master responses, some of them several in a line."""
    each = _mixed_herds(spark, sf_dir).select((F.col("o_orderkey") % 1000).alias("line"), F.floor(F.col("o_orderkey") / 1000).alias("batch"), F.col("herd"))
    lines = each.select("line", "batch", F.to_json("herd").alias("j")).groupBy("line", "batch").agg(F.array_join(F.array_sort(F.collect_list("j")), ",").alias("j"), F.count("*").alias("n"))
    path = f"{shared_dir(prepare(spark))}/landed-{uuid.uuid4().hex[:12]}"
    lines.select(F.when((F.col("n") == 1) & (F.col("line") % 2 == 0), F.col("j")).otherwise(F.concat(F.lit("["), "j", F.lit("]"))).alias("value")).write.text(path)
    return R.herd_masters(R.responses(spark, path, kind))


def _mixed_properties(spark: SparkSession, sf_dir: str, kind: str = R.PROPERTY) -> DataFrame:
    """`_properties` with herds, events, agreements and their members in varied forms; of a customer's orders every fourth is a
    property response of its own, so that properties with one herd occur."""
    k = F.col("c_custkey")
    herds = _mixed_herds(spark, sf_dir).groupBy(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey")).alias("part")).agg(F.collect_list(F.to_json("herd")).alias("h"))
    seen = F.transform(F.sequence(F.lit(1), (k % 3 + 1).cast("int")), lambda i: F.struct(F.concat(F.lit("S"), i).alias("SygdomsKode"), F.lit("2022-01-02T00:00:00").alias("DatoVeterinaerStatus")))
    members = F.struct(F.lit("15").alias("DyreArtKode"), _varied(k, F.array((k + 1).cast("string"), F.lit("0"), F.lit("x"), (k + 2).cast("string")), "ChrNummer").alias("ChrNumre"))
    alone = [F.struct(F.lit("15").alias("DyreArtKode"), _varied(k, F.array((k + i).cast("string")), "ChrNummer").alias("ChrNumre")) for i in (1, 2)]
    agreements = F.when(k % 8 == 0, F.array(*alone)).otherwise(F.array(members))
    own = F.col("part").isNull()
    there = read(spark, sf_dir, "customer").select("c_custkey", F.lit(None).cast("long").alias("part")).unionByName(herds.where("part IS NOT NULL").select("c_custkey", "part"))
    rows = there.alias("t").join(herds.alias("h"), (F.col("t.c_custkey") == F.col("h.c_custkey")) & F.col("t.part").eqNullSafe(F.col("h.part")), "left").select("t.*", "h.h")
    rows = rows.join(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "left_semi")
    items = F.transform("h", F.parse_json)
    out = rows.select(
        k.cast("string").alias("ChrNummer"),
        F.when(own & (k % 7 != 0), F.struct(F.lit("Nej").alias("VeterinaereProblemer"), _varied(k, seen).alias("VeterinaerHaendelse"))).alias("VeterinaereHaendelser"),
        F.when(own & (k % 2 == 0), _varied(k + 1, agreements, "Samdrift")).alias("SamdriftNaboaftaler"),
        _varied(F.coalesce("part", k), items, "Besaetning").alias("Besaetninger"),
    )
    return R.responses(spark, landed(spark, out), kind)


@query(ORACLES["herd_records"])
def mixed_herd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Herd master responses whose sizes came as a list or as one record, and lines that hold one or several."""
    return R.herd_rows(_mixed_masters(spark, sf_dir, R.HERD_ROWS))


@query(ORACLES["property_herds"])
def mixed_property_herds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property responses whose herds came as a list, as one record, or inside an element."""
    return R.herd_rows(R.herds_of(_mixed_properties(spark, sf_dir, R.PROPERTY_HERDS)))


@query(ORACLES["veterinary_events"])
def mixed_veterinary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.events(_mixed_properties(spark, sf_dir, R.PROPERTY_ROWS)).select("chr_number", "disease_code", "status_date")


@query(ORACLES["agreement_members"])
def mixed_agreement_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreements and their members as lists, single records, or inside an element."""
    return R.agreements(_mixed_properties(spark, sf_dir, R.PROPERTY_ROWS))


@query(ORACLES["declaration_records"])
def mixed_declaration_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.declarations(_mixed_masters(spark, sf_dir, R.DECLARATIONS))


def _arrivals(spark: SparkSession, sf_dir: str, kind: str = R.HERD) -> DataFrame:
    """Herd master responses that were landed in the order of their keys, each file a range of them; every eighth came twice."""
    k = F.col("o_orderkey")
    twice = _herds(spark, sf_dir).withColumn("again", F.explode(F.when(k % 8 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    herd = F.col("herd").withField("BesaetningsNummer", (k % 40 + 1).cast("string"))
    path = f"{shared_dir(prepare(spark))}/landed-{uuid.uuid4().hex[:12]}"
    files = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = twice.select(k, "again", F.to_json(herd).alias("value")).repartitionByRange(files, "o_orderkey").sortWithinPartitions("o_orderkey", "again")
    rows.select("value").write.text(path)
    return R.herd_masters(R.responses(spark, path, kind))


@query(f"""
    SELECT chr_number, herd_number, role, cvr_number, cpr_number, name, address, city, postal_code, postal_district, municipality_code, municipality_name, phone, mobile, email, address_protection, advertising_protection FROM (
    SELECT p.*, row_number() OVER (PARTITION BY coalesce(cvr_number, cpr_number), chr_number, herd_number ORDER BY o_orderkey) AS k FROM ({_PERSON.format(role="'owner'").replace("nullif(o_orderkey % 40, 0)", "o_orderkey % 40 + 1").replace("SELECT nullif", "SELECT o_orderkey, nullif")}) p) WHERE k = 1""")
def first_person_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners with all their columns, once a person, property and herd, as they came first."""
    return R.first_persons(_arrivals(spark, sf_dir, R.OWNERS), "Ejer", "owner")


@query("""
    SELECT nullif(o_custkey, 0) AS chr_number, o_orderkey % 40 + 1 AS herd_number, o_orderkey % 11 AS practice_number, 'Praksis' AS name, CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS postal_code,
           CAST(NULL AS VARCHAR) AS postal_district, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS mobile, 'dyr' || min(o_orderkey) || '@x.example' AS email
    FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 GROUP BY o_custkey, o_orderkey % 40, o_orderkey % 11""")
def first_practice_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Practices with all their columns, once a practice, property and herd, as they came first."""
    return R.first_practices(_arrivals(spark, sf_dir, R.PRACTICES))


@query("SELECT s_nationkey::BIGINT AS species_code, s_name AS species_text, s_suppkey % 9 AS usage_code, CAST(NULL AS VARCHAR) AS usage_text FROM supplier WHERE s_suppkey % 4 <> 0")
def usage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combinations of species and usage; those whose usage is no number, or isn't there, are none."""
    k = F.col("s_suppkey")
    usage = F.when(k % 8 == 0, "x").when(k % 4 != 0, (k % 9).cast("string"))
    df = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("DyreArtKode"), F.concat(F.lit(" "), "s_name").alias("DyreArtTekst"), usage.alias("BrugsArtKode"), F.lit(" ").alias("BrugsArtTekst"))
    return R.usages(R.responses(spark, landed(spark, df), R.USAGE))


def _herd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by nation as cursor pages that overlap, with numbers that are none among them."""
    n = F.col("s_suppkey")
    rows = read(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 5).cast("string").alias("DyreArtKode"), (F.col("s_nationkey") % 2).cast("string").alias("BrugsArtKode"), n, F.explode(F.array(F.floor(n / 10), F.floor(n / 10) + 1)).alias("page"))
    return rows.groupBy("DyreArtKode", "BrugsArtKode", (F.col("page") * 10).cast("string").alias("FraNummer")).agg(F.concat(F.collect_list(n.cast("string")), F.array(F.lit("0"), F.lit("-4"), F.lit("x"))).alias("BesNrListe"))


@query("SELECT DISTINCT s_suppkey AS herd_number, (s_nationkey % 5)::BIGINT AS species_code, (s_nationkey % 2)::BIGINT AS usage_code FROM supplier WHERE s_suppkey > 0")
def herd_number_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.herd_numbers(R.responses(spark, landed(spark, _herd_pages(spark, sf_dir)), R.HERD_LIST))


@query("""
    SELECT (s_nationkey % 5)::BIGINT AS species_code, (s_nationkey % 2)::BIGINT AS usage_code, CASE WHEN max(s_suppkey) >= (max(s_suppkey) // 10 + 1) * 10 THEN max(s_suppkey) + 1 END AS next FROM supplier GROUP BY 1, 2""")
def herd_list_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlapping last page brings nothing new, so every combination has come to its end."""
    return R.last_cursors(R.responses(spark, landed(spark, _herd_pages(spark, sf_dir)), R.HERD_LIST))


@query("SELECT s_suppkey AS herd_number, s_nationkey::BIGINT AS species_code, CAST(NULL AS BIGINT) AS usage_code, s_name AS chk_number, 'aktiv' AS status FROM supplier")
def listed_herds(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("BesaetningsNummer"), F.col("s_nationkey").cast("string").alias("DyreArtKode"), F.lit("?").alias("BrugsArtKode"), F.concat(F.col("s_name"), F.lit(" ")).alias("CHKNummer"), F.lit("aktiv").alias("Status"))
    return R.listed_herds(R.responses(spark, landed(spark, df), "BesaetningsNummer:string,DyreArtKode:string,BrugsArtKode:string,CHKNummer:string,Status:string"))
