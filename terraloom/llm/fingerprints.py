"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.llm.frames import text_or_empty

#: Words in a term, bins of a fingerprint, and hexadecimal digits of a bin's sample.
TERM_WORDS, BINS, DIGITS = 5, 256, 4
BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bits(hashed: Column, first: int, count: int) -> Column:
    return F.call_function("shiftrightunsigned", hashed, F.lit(first)).bitwiseAND(F.lit((1 << count) - 1).cast("long"))


@lru_cache
def gamma_quantiles() -> tuple[str, str]:
    """Gamma(2, 1) at 2^16 even quantiles, and its logarithms, as JSON: drawing a row of it draws from Gamma(2, 1)."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.sqrt(2 * p) + 2 * p
    for _ in range(60):  # Newton on 1 - (1 + x) exp(-x) = p
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), x / 2)
    return json.dumps([float(f"{v:.6g}") for v in x]), json.dumps([float(f"{v:.6g}") for v in np.log(x)])


def weighted_terms(text: Column, n: int = TERM_WORDS) -> Column:
    """array<bigint>: hashes of the units of weight of the distinct terms. A term is n words on end, in lower case; a text
    with fewer words is one term, a text without words has none. A term's weight is its number of occurrences, and a term
    of weight w is w units: (term), (term, 1) .. (term, w - 1). Two texts share min(w, v) of a term's units and have
    max(w, v) of them together, so the Jaccard similarity of the units is the generalised one of the weights."""
    words = F.array_remove(F.split(F.lower(text), BLANKS), "")

    def terms(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        several = let(hashes, lambda h: F.slice(F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, n)))), 1, F.greatest(F.size(h) - (n - 1), F.lit(1))))
        return F.when(F.size(w) > 0, several).otherwise(F.array().cast("array<bigint>"))

    def units(s: Column) -> Column:
        # Equal terms are neighbours once sorted: where each run starts, and how long it is.
        first = F.filter(F.transform(s, lambda x, i: F.when(F.coalesce(F.get(s, i - 1) != x, F.lit(True)), i)), lambda i: i.isNotNull())
        more = lambda h, w: F.transform(F.sequence(F.lit(1), w - 1), lambda k: F.xxhash64(h, k))

        def runs(f: Column) -> Column:
            length = F.zip_with(f, F.slice(f, 2, F.greatest(F.size(f), F.lit(1))), lambda a, b: F.struct(F.get(s, a).alias("h"), (F.coalesce(b, F.size(s)) - a).alias("w")))
            heavy = F.filter(length, lambda t: t["w"] > 1)
            return F.concat(F.transform(length, lambda t: t["h"]), F.flatten(F.transform(heavy, lambda t: more(t["h"], t["w"]))))

        return let(first, runs)

    return let(words, lambda w: let(terms(w), lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), t).otherwise(let(F.sort_array(t), units))))


def sketch(text: Column, bins: int = BINS) -> Column:
    """array<int>: the digest of the sample of each bin of units, -1 for a bin without one.

    Of each unit, r and c from Gamma(2, 1) and b uniform are drawn from its hash alone. It has weight 1, so its quantised
    weight is t = floor(ln 1 / r + b) = 0, and ln a = ln c - r (1 - b). The unit with the smallest a is its bin's
    sample. The units of two texts together are dealt to bins by their hashes, each is as likely to be the smallest of
    its bin as any other there, and bins have equal shares of units on average: the expected rate of equal samples among the bins in use is
    the Jaccard similarity of the units, for texts with few units as for those with many."""
    gamma, log_gamma = (F.from_json(F.lit(x), "array<double>") for x in gamma_quantiles())
    low = F.lit((1 << 4 * DIGITS) - 1).cast("long")
    none = F.array(*(F.lit((b << 45) | ((1 << 45) - 1)) for b in range(bins)))  # comes last in its bin

    def packed(h: Column) -> Column:
        """Bin, order of ln a, digest: sorting puts a bin's smallest first."""
        ln_a = F.get(log_gamma, bits(h, 8, 16).cast("int")) - F.get(gamma, bits(h, 24, 16).cast("int")) * (F.lit(1.0) - bits(h, 40, 20) / float(1 << 20))
        order = F.greatest((ln_a + 128) * 2097152.0, F.lit(0.0)).cast("long")
        return F.pmod(h, F.lit(bins)) * (1 << 45) + order * (1 << 16) + F.xxhash64(h).bitwiseAND(low)

    bin_of = lambda x: F.call_function("shiftright", x, F.lit(45))
    place = F.lit((1 << 45) - 1)
    firsts = lambda k: F.filter(k, lambda x, i: F.coalesce(bin_of(F.get(k, i - 1)) != bin_of(x), F.lit(True)))
    keys = let(weighted_terms(text), lambda t: F.sort_array(F.concat(F.transform(t, packed), none)))
    return F.transform(let(keys, firsts), lambda x: F.when(x.bitwiseAND(place) == place, F.lit(-1)).otherwise(x.bitwiseAND(low).cast("int")))


def fingerprint(sketched: Column) -> Column:
    """A sketch as a string: DIGITS hexadecimal digits for each bin, dots for a bin without a term."""
    return F.array_join(F.transform(sketched, lambda x: F.when(x < 0, F.lit("." * DIGITS)).otherwise(F.lower(F.lpad(F.hex(x), DIGITS, "0")))), "")


def likeness(a: Column, b: Column) -> Column:
    """The rate of equal samples among the bins in which either sketch has one; 1 if neither has any. Null if one is null."""
    agree = F.zip_with(a, b, lambda x, y: F.when((x >= 0) | (y >= 0), x == y))
    return let(
        F.filter(agree, lambda e: e.isNotNull()),
        lambda used: F.when(F.size(used) == 0, F.lit(1.0)).otherwise(F.size(F.filter(used, lambda e: e)) / F.size(used)),
    )


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", parts: int | None = None) -> DataFrame:
    """`docs` with next_<column> of each column: the next row's by descending id; the last row's next is the first.

    The ids are cut into as many ranges as there are shuffle partitions, at quantiles, and each range is ordered for
    itself. A range also gets, as a guest, the row that follows its last one: the largest of the next lower range, and
    in the lowest range the largest of all. So every row is shuffled once, and no task holds more than a range.
    Rows with equal ids are ordered by `columns` and are in one range. Rows with a null id come last, by the hashes of their
    columns, which are spread over ranges like ids; ids must be above -2^61. A table of one row is its own next.
    """
    spark = docs.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62)) - F.pmod(F.xxhash64(*columns), F.lit(1 << 61)))
    ids = docs.select(key.alias("id"))
    cuts = ids.agg(F.percentile_approx("id", F.array(*(F.lit((i + 1) / n) for i in range(n))), F.lit(100 * n)).alias("q")).head().q or []
    cuts = sorted(set(cuts[:-1]))
    bounds = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast("array<bigint>")
    part = lambda c: F.size(F.filter(bounds, lambda b: b < c))
    tops = {r.part: r.top for r in ids.groupBy(part(F.col("id")).alias("part")).agg(F.max("id").alias("top")).collect()}  # a row a range
    there = sorted(tops)
    guests = {tops[a]: b for a, b in zip(there, there[1:], strict=False)}
    if there:
        guests_first = tops[there[-1]]
    to = F.array(F.struct(part(F.col("_id")).alias("part"), F.lit(0).alias("guest")))
    if guests:
        marks = F.create_map(*(F.lit(x) for pair in guests.items() for x in pair))
        to = F.when(F.element_at(marks, F.col("_id")).isNotNull(), F.concat(to, F.array(F.struct(F.element_at(marks, F.col("_id")).alias("part"), F.lit(1).alias("guest"))))).otherwise(to)
    if there:
        to = F.when(F.col("_id") == guests_first, F.concat(to, F.array(F.struct(F.lit(there[0]).alias("part"), F.lit(2).alias("guest"))))).otherwise(to)
    spread = docs.withColumn("_id", key).withColumn("_to", F.explode(to)).select("*", "_to.part", "_to.guest").drop("_to")
    order = Window.partitionBy("part").orderBy("guest", F.desc("_id"), *columns)
    out = spread.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return out.where("guest = 0").drop("part", "guest", "_id")


def edited(text: Column, following: Column) -> Column:
    """The text whose last floor(n / 2) code points are replaced by the first as many of the following text, or all."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every whole text.

    Null counts as empty; an empty text has a fingerprint without samples, and two such are alike (1). Equal texts have
    equal fingerprints. Repeated rows stay repeated, and with a repeated id the smaller text is the next one. Extra
    columns are not read. An empty table: no rows.
    """
    given = docs.select(id_col, text_or_empty(text_col).alias("text")).withColumn("sketch", sketch(F.col("text")))
    both = with_next(given, ["text", "sketch"], id_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    done = both.withColumn("edited_sketch", sketch(F.col("edited")))
    return done.select(
        id_col,
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
