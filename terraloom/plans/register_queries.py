"""Queries of register operators: cleaning, codes, dates, joins, profiles, windows, accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraloom.functions import clean as C
from terraloom.functions import dates as D
from terraloom.operators import dedupe, livestock, mapping, nitrogen, quality
from terraloom.plans.registry import registry
from terraloom.plans.status import category_counts, status_category
from terraloom.session import read

QUERIES, ORACLES, query = registry()
ORDER_STATUS = {"F": "Completed", "O": "Action Required"}
_CATEGORY = "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Action Required' ELSE 'Unknown' END"


@query(f"SELECT {_CATEGORY} AS status_category, count(*) AS features FROM orders GROUP BY 1")
def status_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(status_category(F.col("o_orderstatus"), ORDER_STATUS).alias("status_category"))
    return category_counts(orders, "status_category")


@query("""
    SELECT event_id, TRY_CAST(k AS BIGINT) AS whole, CAST(NULL AS BIGINT) AS not_whole, TRY_CAST(k || '.5' AS DOUBLE) AS comma,
           TRY_CAST(k || '.' AS DOUBLE) AS digits, CAST(NULL AS VARCHAR) AS blank, event_type || '_x' AS cleaned
    FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""")
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return read(spark, sf_dir, "events").select(
        "event_id",
        C.to_int(F.concat(F.lit("\t "), k, F.lit("  "))).alias("whole"),
        C.to_int(F.concat(k, F.lit(".5"))).alias("not_whole"),
        C.to_float(F.concat(F.lit(" "), k, F.lit(",5"))).alias("comma"),
        C.digits_to_float(F.concat(F.lit("kr "), k, F.lit(".-"))).alias("digits"),
        C.clean_text(F.lit(" \n ")).alias("blank"),
        C.clean_text(F.concat(F.lit("\n"), F.col("event_type"), F.lit("_x  "))).alias("cleaned"),
    )


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag = 'R' AS is_true, CAST(l_returnflag = 'A' AS INTEGER) AS yes,
           CASE l_linestatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS flag,
           CASE l_linenumber WHEN 1 THEN 'ha' WHEN 2 THEN 'm2' WHEN 3 THEN 'stk' WHEN 4 THEN 'm3' WHEN 5 THEN 'ton' END AS unit,
           CASE WHEN l_linenumber % 3 = 0 THEN '6-12%' WHEN l_linenumber % 3 = 1 THEN '>12%' END AS peat
    FROM lineitem WHERE l_quantity >= 25""")
def flags_and_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terraloom.sources.sheets import AREA_UNITS

    n = F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return read(spark, sf_dir, "lineitem").where("l_quantity >= 25").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        C.is_true(F.when(flag == "R", "TRUE").otherwise("no")).alias("is_true"),
        C.yes_flag(F.when(flag == "A", "Ja").when(flag == "N", "Nej")).alias("yes"),
        C.sand_falsk(F.when(status == "O", "SAND").when(status == "F", "FALSK").otherwise("?")).alias("flag"),
        C.lookup(n, AREA_UNITS).alias("unit"),
        C.peat_class(F.when(n % 3 == 0, "12").when(n % 3 == 1, "60")).alias("peat"),
    )


@query("""
    SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 12 MONTH, '%Y-%m-%d') AS period_from,
           strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y-%m-%d') AS period_to,
           strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS next_update
    FROM orders""")
def trailing_12_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = D.trailing_year(F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", D.iso_date(first).alias("period_from"), D.iso_date(last).alias("period_to"), D.iso_date(D.next_update(F.col("o_orderdate"), F.lit("weekly"))).alias("next_update")
    )


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_first, strftime(o_orderdate, '%Y-%m-%d') AS iso,
           epoch_ms(o_orderdate) // 1000 AS epoch_s, year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS plan_year
    FROM orders""")
def register_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    name = F.concat(F.lit("sheet_"), F.year(d), F.lit("_"), F.year(d) + 1, F.lit(".csv"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        D.iso_date(D.day_first(F.concat(F.lit(" "), F.date_format(d, "dd-MM-yyyy")))).alias("day_first"),
        D.iso_date(D.iso_timestamp(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))).alias("iso"),
        F.unix_seconds(D.epoch_millis(F.unix_millis(d.cast("timestamp")))).alias("epoch_s"),
        D.plan_year(name).alias("plan_year"),
    )


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return parsed.groupBy(F.col("p.k").alias("k")).agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query("SELECT unnest(json_keys(props)) AS key, count(*) AS records FROM events GROUP BY 1")
def structure_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.structure_profile(read(spark, sf_dir, "events"), "props")


_LINE_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"""
    SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY {_LINE_ORDER}) AS k FROM lineitem) WHERE k = 1""")
def first_seen_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedupe.first_seen(read(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"], _LINE_ORDER.split(", "))
    return kept.select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.latest(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type"])


@query("SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer) WHERE k <= 5")
def sample_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five herds of each combination: the sampling operator."""
    return dedupe.sample_per_group(read(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), ["c_nationkey"], ["c_custkey"], 5)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200")
def offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of a service's answer: rows 200 to 299."""
    return dedupe.page(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 200, 100)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS number FROM orders")
def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.numbered(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "number").select("o_orderkey", F.col("number").cast("long"))


@query("SELECT DISTINCT o_custkey AS herd_number FROM orders WHERE o_custkey > 0 ORDER BY 1")
def herd_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = C.to_int(F.col("o_custkey").cast("string"))
    return read(spark, sf_dir, "orders").select(n.alias("herd_number")).where("herd_number > 0").distinct().orderBy("herd_number")


@query("""
    SELECT o_orderkey, o_custkey, coalesce(c_name, 'order') AS name, c_nationkey FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def herd_property_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    herds = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("chr_number"), F.lit("order").alias("name"))
    properties = read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("chr_number"), F.col("c_name").alias("name"), "c_nationkey")
    return livestock.join_herds(herds, properties).select("o_orderkey", F.col("chr_number").alias("o_custkey"), "name", "c_nationkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(done, "c_custkey", "left_semi")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey % 40 = 1)")
def anti_join_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = read(spark, sf_dir, "orders").where("o_orderkey % 40 = 1").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(seen, "c_custkey", "left_anti")


@query("""
    SELECT r_name, n_name, s_suppkey, s_name FROM region JOIN nation ON r_regionkey = n_regionkey JOIN supplier ON n_nationkey = s_nationkey
    WHERE n_nationkey <> 0""")
def expansion_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species (region) to usages (nation) to herds (supplier); usages with code 0 are dropped."""
    species = read(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "species")
    usages = read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("species"), F.col("n_nationkey").alias("usage"), "n_name").where("usage <> 0")
    herds = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("usage"), "s_suppkey", "s_name")
    return species.join(usages, "species").join(herds, "usage").select("r_name", "n_name", "s_suppkey", "s_name")


@query("SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem WHERE l_partkey <> 0")
def agreement_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("chr_numbers"))
    return livestock.agreement_edges(members, "l_orderkey", "chr_numbers").select("src", "dst")


@query("""
    SELECT l_suppkey AS sender, o_custkey AS receiver, count(*) AS declarations, strftime(min(l_shipdate), '%Y-%m-%d') AS start_date,
           strftime(max(l_shipdate), '%Y-%m-%d') AS end_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def delivery_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("receiver"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("sender"), "l_shipdate")
    out = lines.join(orders, "l_orderkey").groupBy("sender", "receiver").agg(F.count("*").alias("declarations"), F.min("l_shipdate").alias("start_date"), F.max("l_shipdate").alias("end_date"))
    return mapping.as_published(out)


_HERDS = """SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 'I alt' ELSE o_orderpriority END AS txt FROM orders"""


def _properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested property responses: a customer's property with a herd for each order."""
    k = F.col("o_orderkey")
    size = F.struct(F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, "I alt").otherwise(F.col("o_orderpriority")).alias("BesaetningsStoerrelseTekst"), (k % 100).alias("BesaetningsStoerrelse"))
    person = F.struct(
        F.when(k % 3 == 0, F.lit(" ")).otherwise((F.col("o_custkey") % 50).cast("string")).alias("CvrNummer"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.concat(F.lit("p"), F.col("o_custkey") % 20)).alias("CprNummer"),
        F.concat(F.lit(" n"), k).alias("Navn"),
        F.lit("By").alias("By"),
        F.when(k % 2 == 0, "Ja").otherwise("Nej").alias("Adressebeskyttelse"),
        F.lit(None).cast("string").alias("Reklamebeskyttelse"),
    )
    practice = F.struct(F.when(k % 5 != 0, k % 11).alias("PraksisNr"), F.lit("Dyrlæge ").alias("PraksisNavn"))
    herd = F.struct(
        (k % 40).alias("BesaetningsNummer"), F.lit(15).alias("DyreArtKode"), F.lit(1).alias("BrugsArtKode"), F.when(k % 4 == 0, "Ja").alias("Oekologisk"),
        F.array(size).alias("BesStr"), person.alias("Ejer"), person.alias("Bruger"), practice.alias("BesPraksis"),
    )
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ChrNummer"), F.array(herd).alias("Besaetninger"), F.lit(0).alias("page"), k.alias("pos"))


@query(f"""
    SELECT nullif(o_orderkey % 40, 0) AS herd_number, o_custkey AS chr_number, CAST(15 AS INTEGER) AS species_code, CAST(1 AS INTEGER) AS usage_code,
           CAST(o_orderkey % 4 = 0 AS INTEGER) AS is_organic, CASE WHEN o_orderkey % 7 <> 1 THEN txt END AS animal_type,
           CASE WHEN o_orderkey % 7 <> 1 THEN o_orderkey % 100 END AS count
    FROM ({_HERDS})""")
def herd_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return livestock.herd_sizes(_properties(spark, sf_dir))


_PEOPLE = """SELECT o_custkey AS chr_number, o_orderkey % 40 AS herd_number, o_orderkey,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey % 50 AS VARCHAR) END AS cvr_number,
    CASE WHEN o_orderkey % 6 <> 0 THEN 'p' || (o_custkey % 20) END AS cpr_number FROM orders"""


@query(f"""
    SELECT cvr_number, chr_number, herd_number, 'owner' AS role, 'n' || o_orderkey AS name,
           CASE WHEN o_orderkey % 2 = 1 THEN 'By' END AS city, CAST(o_orderkey % 2 = 0 AS INTEGER) AS address_protection, CAST(0 AS INTEGER) AS advertising_protection
    FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(cvr_number, cpr_number), chr_number, herd_number ORDER BY o_orderkey) AS k
          FROM ({_PEOPLE}) WHERE coalesce(cvr_number, cpr_number) IS NOT NULL) WHERE k = 1""")
def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return livestock.published(livestock.people(_properties(spark, sf_dir), "Ejer", "owner"))


@query("""
    SELECT DISTINCT o_orderkey % 11 AS practice_number, o_custkey AS chr_number, o_orderkey % 40 AS herd_number, 'Dyrlæge' AS name
    FROM orders WHERE o_orderkey % 5 <> 0""")
def practices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return livestock.practices(_properties(spark, sf_dir))


@query(f"""
    SELECT 'herds' AS entity, count(*) AS rows FROM orders WHERE o_orderkey % 7 <> 1 UNION ALL
    SELECT 'properties', count(DISTINCT o_custkey) FROM orders UNION ALL
    SELECT 'owners', count(DISTINCT (coalesce(cvr_number, cpr_number), chr_number, herd_number)) FROM ({_PEOPLE}) WHERE coalesce(cvr_number, cpr_number) IS NOT NULL UNION ALL
    SELECT 'users', count(DISTINCT (coalesce(cvr_number, cpr_number), chr_number, herd_number)) FROM ({_PEOPLE}) WHERE coalesce(cvr_number, cpr_number) IS NOT NULL UNION ALL
    SELECT 'practices', count(DISTINCT (o_orderkey % 11, o_custkey, o_orderkey % 40)) FROM orders WHERE o_orderkey % 5 <> 0""")
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _properties(spark, sf_dir)
    entities = {
        "herds": livestock.herd_sizes(p).where("`count` IS NOT NULL"),
        "properties": dedupe.first_seen(p.select("ChrNummer", "page", "pos"), ["ChrNummer"], ["page", "pos"]),
        "owners": livestock.people(p, "Ejer", "owner"),
        "users": livestock.people(p, "Bruger", "user"),
        "practices": livestock.practices(p),
    }
    return mapping.union_all([df.agg(F.count("*").alias("rows")).select(F.lit(k).alias("entity"), "rows") for k, df in entities.items()])


_COMBOS = "SELECT n_nationkey AS nation, s AS segment FROM nation, (SELECT DISTINCT c_mktsegment AS s FROM customer)"
_PROFILE = f"""SELECT nation, segment, count(c_custkey) AS herds, min(c_custkey) AS min_herd, max(c_custkey) AS max_herd, count(c_custkey) = 10000 AS capped
    FROM ({_COMBOS}) LEFT JOIN customer ON nation = c_nationkey AND segment = c_mktsegment GROUP BY 1, 2"""


def _combos(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_custkey")
    segments = customers.agg(F.collect_set("segment").alias("s")).select(F.lit(1).alias("one"), F.explode("s").alias("segment"))  # a code list of a few values
    nations = read(spark, sf_dir, "nation").select(F.lit(1).alias("one"), F.col("n_nationkey").alias("nation"))
    return nations.join(segments, "one").drop("one"), customers


@query(_PROFILE)
def combo_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return livestock.combo_profile(*_combos(spark, sf_dir), ["nation", "segment"], "c_custkey")


@query(f"""
    SELECT min(herds) AS min_herds, max(herds) AS max_herds, count(*) FILTER (herds = 0) AS "empty", count(*) FILTER (herds BETWEEN 0 AND 100) AS n_0,
           count(*) FILTER (herds BETWEEN 100 AND 1000) AS n_1, count(*) FILTER (herds BETWEEN 1000 AND 5000) AS n_2,
           count(*) FILTER (herds BETWEEN 5000 AND 9999) AS n_3, count(*) FILTER (herds = 10000) AS n_4, count(*) FILTER (herds > 10000) AS n_5
    FROM ({_PROFILE})""")
def combo_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return livestock.combo_distribution(livestock.combo_profile(*_combos(spark, sf_dir), ["nation", "segment"], "c_custkey"))


@query("""
    SELECT event_type, month, events, CAST(sum(events) OVER w AS BIGINT) AS running,
           round(avg(events) OVER (PARTITION BY event_type ORDER BY month RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS avg_12m,
           round(avg(events) OVER (PARTITION BY event_type ORDER BY month RANGE BETWEEN 8 PRECEDING AND CURRENT ROW), 6) AS avg_9m
    FROM (SELECT event_type, CAST(year(ts) * 12 + month(ts) AS INTEGER) AS month, count(*) AS events FROM events GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY event_type ORDER BY month ROWS UNBOUNDED PRECEDING)""")
def rolling_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = read(spark, sf_dir, "events").groupBy("event_type", (F.year("ts") * 12 + F.month("ts")).alias("month")).agg(F.count("*").alias("events"))
    w = Window.partitionBy("event_type").orderBy("month")
    return monthly.select(
        "event_type",
        "month",
        "events",
        F.sum("events").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
        F.round(F.avg("events").over(w.rangeBetween(-11, 0)), 6).alias("avg_12m"),
        F.round(F.avg("events").over(w.rangeBetween(-8, 0)), 6).alias("avg_9m"),
    )


@query("""
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL AS kind FROM customer UNION ALL
    SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier""")
def union_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = mapping.rename(read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), {"c_custkey": "key", "c_name": "name", "c_mktsegment": "segment"})
    b = mapping.rename(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), {"s_suppkey": "key", "s_name": "name"}).withColumn("kind", F.lit("supplier"))
    return mapping.union_all([a, b]).select("key", "name", "segment", "kind")


@query("""
    SELECT doc_id, lower(lang) AS lang, coalesce(quality, toxic) AS mark, NULL AS absent, n_chars AS size
    FROM documents LEFT JOIN labels USING (doc_id)""")
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    df = mapping.rename(df, {"quality": "mark", "toxic": "mark"})
    return mapping.map_fields(df, [("lang", "lang", F.lower), ("mark", "mark", lambda c: c), ("Findes ikke", "absent", C.clean_text), ("n_chars", "size", lambda c: c)], keep=["doc_id"])


@query("SELECT p_partkey, p_brand AS spec_brand, p_size AS spec_size, strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d') AS seen, CAST(p_size > 25 AS INTEGER) AS large FROM part")
def flattened_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").select("p_partkey", F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("spec"))
    df = mapping.flatten_struct(df, "spec").withColumn("seen", F.date_add(F.lit("2024-01-01").cast("date"), F.col("spec_size"))).withColumn("large", F.col("spec_size") > 25)
    return mapping.as_published(df)


@query("SELECT p_partkey, p_brand AS brand, CASE WHEN p_size <> 7 THEN CAST(p_size AS VARCHAR) END AS size FROM part")
def open_schema_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(F.lit("Brand"), F.lit("SIZE"))
    values = F.array(F.col("p_brand"), F.when(F.col("p_size") == 7, F.lit(" ")).otherwise(F.col("p_size").cast("string")))
    m = read(spark, sf_dir, "part").select("p_partkey", mapping.open_map(names, values).alias("m"))
    return m.select("p_partkey", F.try_element_at("m", F.lit("brand")).alias("brand"), F.try_element_at("m", F.lit("size")).alias("size"))


@query("""
    SELECT o_orderkey, list_sort(list_distinct(list_concat(list(l_partkey), list(l_suppkey)))) AS events FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY 1""".replace("AS events", "::VARCHAR AS events"))
def concatenated_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lists of two calls as one, each event once."""
    lists = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_partkey").alias("a"), F.collect_list("l_suppkey").alias("b"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey").distinct()
    both = F.array_sort(F.array_distinct(F.concat(livestock.as_list(F.col("a")), livestock.as_list(F.col("b")))))
    return lists.join(orders, "o_orderkey", "left_semi").select("o_orderkey", F.concat(F.lit("["), F.array_join(both, ", "), F.lit("]")).alias("events"))


@query("""
    SELECT 'doc_id' AS "column", count(doc_id) AS non_null, count(*) AS rows FROM documents LEFT JOIN labels USING (doc_id) UNION ALL
    SELECT 'lang', count(lang), count(*) FROM documents LEFT JOIN labels USING (doc_id) UNION ALL
    SELECT 'quality', count(quality), count(*) FROM documents LEFT JOIN labels USING (doc_id)""")
def non_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "documents").select("doc_id", "lang").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return quality.non_null_profile(df)


@query("""
    SELECT source, count(*) AS features, count(quality) AS valid,
           CASE WHEN count(quality) = 0 THEN 'none valid' WHEN count(quality) < 0.5 * count(*) THEN 'few valid' END AS warning
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def page_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "documents").select("doc_id", "source").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return quality.success_rates(df, "source", F.col("quality").isNotNull())


@query("""
    SELECT count(*) AS before, count(*) FILTER (c_acctbal >= 0 AND c_nationkey <> 0) AS after, count(*) FILTER (NOT c_acctbal >= 0) AS removed_balance,
           count(*) FILTER (c_acctbal >= 0 AND c_nationkey = 0) AS removed_nation
    FROM customer""")
def removed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.removed_counts(read(spark, sf_dir, "customer"), {"balance": F.col("c_acctbal") >= 0, "nation": F.col("c_nationkey") != 0})


@query("""
    SELECT c_custkey, CASE WHEN NOT c_acctbal >= 0 THEN 'balance' WHEN c_nationkey = 0 THEN 'nation' END AS reject_reason
    FROM customer WHERE NOT (c_acctbal >= 0 AND c_nationkey <> 0)""")
def reject_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split_rejects(read(spark, sf_dir, "customer"), {"balance": F.col("c_acctbal") >= 0, "nation": F.col("c_nationkey") != 0})[1].select("c_custkey", "reject_reason")


@query("SELECT c_mktsegment AS batch, count(*) AS features, round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY 1")
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("batch")).agg(F.count("*").alias("features"), F.round(F.avg("c_acctbal"), 4).alias("mean"))


_FARMS = """SELECT o_custkey AS CVR, CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE count(*) * 10.0 END AS F_504_1, CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE 5.0 END AS F_505_1,
    CASE WHEN o_custkey % 3 <> 0 THEN count(*) * 12.0 END AS F_512, count(*) * 8.0 AS F_901, count(*) * 2.0 AS F_610, count(*) * 4.0 AS F_706_1, count(*) * 2.0 AS F_193
    FROM orders GROUP BY o_custkey"""
_ACCOUNTS = f"""SELECT *, F_901 / nullif(final_quota, 0) AS performance, F_610 / F_901 AS share_F_610, F_706_1 / F_901 AS share_F_706_1, F_193 / F_901 AS share_F_193
    FROM (SELECT *, coalesce(final_quota / nullif(original_quota, 0), 1.0) AS factor
          FROM (SELECT *, coalesce(F_512, F_504_1 + F_505_1) AS final_quota, F_504_1 + F_505_1 AS original_quota FROM ({_FARMS})))"""


def _farms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("CVR"), F.col("n").cast("double")
    counted = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("CVR")).agg(F.count("*").alias("n"))
    return counted.select(
        "CVR",
        F.when(k % 5 == 0, 0.0).otherwise(n * 10).alias("F_504_1"),
        F.when(k % 5 == 0, 0.0).otherwise(5.0).alias("F_505_1"),
        F.when(k % 3 != 0, n * 12).alias("F_512"),
        *((n * w).alias(c) for c, w in (("F_901", 8), ("F_610", 2), ("F_706_1", 4), ("F_193", 2))),
    )


@query(f"""
    SELECT CVR, CAST(original_quota AS DOUBLE) AS original_quota, CAST(final_quota AS DOUBLE) AS final_quota, round(factor, 6) AS factor,
           round(performance, 6) AS performance, round(share_F_610, 6) AS share_F_610 FROM ({_ACCOUNTS})""")
def nitrogen_farm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nitrogen.farm_accounts(_farms(spark, sf_dir))
    return out.select("CVR", "original_quota", "final_quota", *(F.round(c, 6).alias(c) for c in ("factor", "performance", "share_F_610")))


@query(f"""
    SELECT CVR, count(*) AS fields, round(sum(adjusted), 2) AS adjusted_quota, round(sum(adjusted * performance), 2) AS consumption,
           round(sum(adjusted * performance * share_F_706_1), 2) AS consumption_F_706_1
    FROM (SELECT a.*, CASE WHEN l_extendedprice > 1000 THEN l_quantity * factor END AS adjusted
          FROM ({_ACCOUNTS}) a JOIN orders ON CVR = o_custkey JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY 1""")
def nitrogen_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("CVR"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").alias("n_kvote"), F.when(F.col("l_extendedprice") > 1000, F.col("l_extendedprice")).otherwise(0.0).alias("harmoni_areal"))
    out = nitrogen.field_accounts(nitrogen.farm_accounts(_farms(spark, sf_dir)), lines.join(orders, "l_orderkey").drop("l_orderkey"))
    sums = [F.round(F.sum(c), 2).alias(c) for c in ("adjusted_quota", "consumption", "consumption_F_706_1")]
    return out.groupBy("CVR").agg(F.count("*").alias("fields"), *sums)


@query(f"""
    SELECT 'shares' AS "check", 'error' AS severity, count(*) FILTER (abs(share_F_610 + share_F_706_1 + share_F_193 - 1) > 1e-9) AS failing_rows FROM ({_ACCOUNTS}) UNION ALL
    SELECT 'quota', 'error', count(*) FILTER (original_quota = 0) FROM ({_ACCOUNTS}) UNION ALL
    SELECT 'high', 'warning', count(*) FILTER (coalesce(performance > 0.9, FALSE)) FROM ({_ACCOUNTS}) UNION ALL
    SELECT 'negative', 'warning', count(*) FILTER (CVR % 3 = 0) FROM ({_ACCOUNTS}) UNION ALL
    SELECT 'matched', 'error', count(*) FILTER (CVR % 2 = 1) FROM ({_ACCOUNTS}) UNION ALL
    SELECT 'harmonised', 'error', count(*) FILTER (CVR % 4 = 0) FROM ({_ACCOUNTS})""")
def nitrogen_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six checks of accounts: shares, quota, consumption, transfers, numbers on both sides, areas."""
    accounts = nitrogen.farm_accounts(_farms(spark, sf_dir))
    k = F.col("CVR")
    fields = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("CVR")).distinct().where("CVR % 2 = 0")
    fields = fields.select("CVR", F.lit(10.0).alias("area"), F.when(k % 4 == 0, 10.5).otherwise(10.0).alias("harmonised_area"))
    both = accounts.withColumn("transfer", F.when(k % 3 == 0, -1.0).otherwise(0.0)).join(fields, "CVR", "left")
    return quality.check_table(both, nitrogen.checks())


@query("SELECT p_brand AS scheme, round(sum(p_retailprice * l_quantity), 0) AS amount, count(*) AS areas FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def subsidy_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("scheme"), "p_retailprice")
    out = nitrogen.support_amounts(read(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity").join(part, "l_partkey"), "scheme", "p_retailprice", "l_quantity")
    return out.withColumn("amount", F.round("amount", 0))


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, coalesce(p_type, 'unknown') AS crop_type FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10
    WHERE l_shipdate >= TIMESTAMP '1995-01-01'""")
def crop_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    crops = read(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    fields = read(spark, sf_dir, "lineitem").where("l_shipdate >= TIMESTAMP '1995-01-01'").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    return fields.join(crops, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_quantity", F.coalesce("p_type", F.lit("unknown")).alias("crop_type"))


@query("""
    SELECT coalesce(c_custkey, s_suppkey) AS key, c_name, s_name, coalesce(n, 0) AS orders FROM customer FULL JOIN supplier ON c_custkey = s_suppkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = coalesce(c_custkey, s_suppkey)""")
def register_integration(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    b = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    n = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("orders"))
    return a.join(b, "key", "full").join(n, "key", "left").select("key", "c_name", "s_name", F.coalesce("orders", F.lit(0).cast("long")).alias("orders"))


@query("""
    SELECT s_suppkey, s_nationkey AS species_code, TRY_CAST(CASE WHEN s_suppkey % 4 = 0 THEN 'x' ELSE CAST(s_suppkey % 9 AS VARCHAR) END AS BIGINT) AS usage_code,
           CASE WHEN s_suppkey % 4 = 0 THEN 'usage' END AS reject_reason FROM supplier""")
def reference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    df = read(spark, sf_dir, "supplier").select(k, F.col("s_nationkey").alias("species_code"), C.to_int(F.when(k % 4 == 0, "x").otherwise((k % 9).cast("string"))).alias("usage_code"))
    return quality.with_reason(df, {"species": F.col("species_code").isNotNull(), "usage": F.col("usage_code").isNotNull()})


