"""Entities of the livestock register out of nested responses, their links, and profiles of codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.clean import bucket_counts, clean_text, person_id, positive, to_int, yes_flag
from terraloom.operators.dedupe import first_seen


def not_total(text: Column) -> Column:
    """False for a size row that sums up others; a row without a text is not one."""
    return ~F.coalesce(F.lower(text).startswith("i alt"), F.lit(False))


def as_list(c: Column, single: Column | None = None) -> Column:
    """An array, also of what came as a single value, or as nothing."""
    return F.coalesce(c, F.array(single)) if single is not None else F.coalesce(c, F.array())


def herd_sizes(properties: DataFrame) -> DataFrame:
    """One row a herd and size that is no total; a herd without sizes keeps one row with nulls."""
    herds = properties.select("ChrNummer", F.explode_outer("Besaetninger").alias("h"), "page", "pos")
    sized = herds.select("*", F.explode_outer(F.filter("h.BesStr", lambda s: not_total(s["BesaetningsStoerrelseTekst"]))).alias("s"))
    return sized.select(
        positive(F.col("h.BesaetningsNummer")).alias("herd_number"),
        F.col("ChrNummer").alias("chr_number"),
        F.col("h.DyreArtKode").alias("species_code"),
        F.col("h.BrugsArtKode").alias("usage_code"),
        yes_flag(F.col("h.Oekologisk")).alias("is_organic"),
        F.col("s.BesaetningsStoerrelseTekst").alias("animal_type"),
        F.col("s.BesaetningsStoerrelse").alias("count"),
    )


def people(properties: DataFrame, source: str, role: str) -> DataFrame:
    """Owners or users, once a person, property and herd, in the order in which they were seen."""
    rows = properties.select("ChrNummer", "page", "pos", F.posexplode("Besaetninger").alias("i", "h"))
    p = f"h.{source}"
    rows = rows.select(
        clean_text(F.col(f"{p}.CvrNummer")).alias("cvr_number"),
        clean_text(F.col(f"{p}.CprNummer")).alias("cpr_number"),
        F.col("ChrNummer").alias("chr_number"),
        F.col("h.BesaetningsNummer").alias("herd_number"),
        F.lit(role).alias("role"),
        clean_text(F.col(f"{p}.Navn")).alias("name"),
        clean_text(F.col(f"{p}.By")).alias("city"),
        yes_flag(F.col(f"{p}.Adressebeskyttelse")).alias("address_protection"),
        yes_flag(F.col(f"{p}.Reklamebeskyttelse")).alias("advertising_protection"),
        "page",
        "pos",
        "i",
    ).withColumn("person", person_id(F.col("cvr_number"), F.col("cpr_number")))
    return first_seen(rows.where("person IS NOT NULL"), ["person", "chr_number", "herd_number"], ["page", "pos", "i"]).drop("page", "pos", "i")


def practices(properties: DataFrame) -> DataFrame:
    rows = properties.select("ChrNummer", "page", "pos", F.posexplode("Besaetninger").alias("i", "h"))
    rows = rows.select(
        to_int(F.col("h.BesPraksis.PraksisNr").cast("string")).alias("practice_number"),
        F.col("ChrNummer").alias("chr_number"),
        F.col("h.BesaetningsNummer").alias("herd_number"),
        clean_text(F.col("h.BesPraksis.PraksisNavn")).alias("name"),
        "page",
        "pos",
        "i",
    )
    return first_seen(rows.where("practice_number IS NOT NULL"), ["practice_number", "chr_number", "herd_number"], ["page", "pos", "i"]).drop("page", "pos", "i")


def published(persons: DataFrame) -> DataFrame:
    """Without person numbers, and without the city of those whose address is protected."""
    return persons.withColumns({"city": F.when(F.col("address_protection") == 0, F.col("city"))}).drop("cpr_number", "person")


def join_herds(herds: DataFrame, properties: DataFrame, key: str = "chr_number") -> DataFrame:
    """Herds with their property; a herd without one is kept, and a property's column wins over a herd's of that name."""
    both = [c for c in properties.columns if c in herds.columns and c != key]
    p = properties.withColumnsRenamed({c: f"_p_{c}" for c in both})
    out = herds.join(p, key, "left")
    return out.withColumns({c: F.coalesce(f"_p_{c}", c) for c in both}).drop(*(f"_p_{c}" for c in both))


def agreement_edges(df: DataFrame, src: str, members: str) -> DataFrame:
    """(src, dst) of each member of a list, without nulls and zeros."""
    return df.select(F.col(src).alias("src"), F.explode(F.filter(members, lambda x: x.isNotNull() & (x != 0))).alias("dst"))


def combo_profile(combos: DataFrame, herds: DataFrame, keys: list[str], number: str, cap: int = 10000) -> DataFrame:
    """Herds of each combination of codes, with smallest and largest number; a combination without herds is kept, one
    with exactly the source's page limit is suspect."""
    counted = herds.groupBy(*keys).agg(F.count(number).alias("herds"), F.min(number).alias("min_herd"), F.max(number).alias("max_herd"))
    out = combos.join(counted, keys, "left").withColumn("herds", F.coalesce("herds", F.lit(0).cast("long")))
    return out.withColumn("capped", F.col("herds") == cap)


def combo_distribution(profile: DataFrame) -> DataFrame:
    return profile.agg(F.min("herds").alias("min_herds"), F.max("herds").alias("max_herds"), F.count_if(F.col("herds") == 0).alias("empty"), *bucket_counts(F.col("herds")))
