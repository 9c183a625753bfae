"""Entries of text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entries(lines: DataFrame, file: str, line: str, text: str, starts: Column) -> DataFrame:
    """Lines with the number of their entry in the file; a line where `starts` holds opens one, others continue it.
    Lines before a file's first entry are no rows."""
    w = Window.partitionBy(file).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("entry", F.sum(starts.cast("int")).over(w)).where("entry > 0")


#: The crop list's header, footers and category words.
CROP_HEADER = "Afgrødekode"
CROP_FOOTERS = ("Miljøstyrelsen", "* Stjernemarkering")
CROP_CATEGORIES = "Omdrift|Natur|græs"


def crop_codes(lines: DataFrame) -> DataFrame:
    """(code, name, category) of the crop list's lines (file, line, text): an entry opens with digits, its category is
    its last word if that is one, other lines continue the name; entries without a category are dropped."""
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    body = lines.withColumn("text", F.trim("text")).withColumn("seen", F.max(F.col("text").contains(CROP_HEADER).cast("int")).over(w))
    footer = F.lit(False)
    for f in CROP_FOOTERS:
        footer = footer | F.col("text").startswith(f)
    body = body.where((F.col("seen") == 1) & ~F.col("text").contains(CROP_HEADER) & ~footer & (F.col("text") != ""))
    found = entries(body, "file", "line", "text", F.col("text").rlike(r"^[0-9]+\s"))
    whole = found.groupBy("file", "entry").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), " ").alias("t"))
    category = rf"(\S*(?:{CROP_CATEGORIES})\S*)"
    out = whole.select(
        F.regexp_extract("t", r"^([0-9]+)", 1).cast("int").alias("code"),
        F.trim(F.regexp_replace(F.regexp_replace("t", r"^[0-9]+\s+", ""), rf"\s*{category}(?!.*{category})", "")).alias("name"),
        F.try_element_at(F.regexp_extract_all("t", F.lit(category), F.lit(1)), F.lit(-1)).alias("category"),
    )
    return out.where("category IS NOT NULL").orderBy("code")
