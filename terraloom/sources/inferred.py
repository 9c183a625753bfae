"""Records whose shape nobody declared: their schema, and a profile of their paths at any depth."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.session import checkpointed


def inferred_schema(rows: DataFrame, value: str = "value") -> str:
    """The type of the JSON objects in a text column, fields in the order of their names. Schemas are merged in parts where the rows
    are, over all rows; a field with values of several kinds stays a VARIANT, one that is always null is text. Lines that are
    no objects count for nothing; without any object it is empty."""
    parsed = F.try_parse_json(value)
    objects = F.when(F.try_variant_get(parsed, "$", "map<string,variant>").isNotNull(), parsed)
    found = rows.select(objects.alias("v")).where("v IS NOT NULL").agg(F.schema_of_variant_agg("v")).head()[0]
    if not found or not found.startswith("OBJECT<"):
        return ""
    # An object without fields has nothing to read.
    ddl = re.sub(r"\bOBJECT<>", "STRING", re.sub(r"\bVOID\b(?=[,>])", "STRING", found))
    return re.sub(r"\bOBJECT<", "STRUCT<", ddl)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines without a declared schema: one pass to infer it, one to read. Lines that are no objects are left out."""
    rows = spark.read.text(path)
    schema = inferred_schema(rows)
    if not schema:
        raise ValueError(f"no JSON objects in {path}")
    objects = F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>").isNotNull()
    return rows.where(objects).select(F.from_json("value", schema).alias("r")).select("r.*")


def _kind(v: Column) -> Column:
    """object, array, null, string, number, boolean or other."""
    name = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    families = {"OBJECT": "object", "ARRAY": "array", "VOID": "null", "STRING": "string", "BOOLEAN": "boolean", "BIGINT": "number", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number"}
    return F.coalesce(F.create_map(*(F.lit(x) for pair in families.items() for x in pair))[name], F.lit("other"))


def path_profile(rows: DataFrame, value: str = "value") -> DataFrame:
    """(path, kind, n): how often each path of the JSON in a text column has a value of each kind. `$` is a line's value, `.name` a
    field, `[*]` an item of a list. A round takes all values one step down, and is written to the shared folder; there are as
    many rounds as the deepest value has steps. Unreadable lines are left out."""
    here = checkpointed(rows.select(F.lit("$").alias("path"), F.try_parse_json(value).alias("v")).where("v IS NOT NULL").withColumn("kind", _kind(F.col("v"))))
    out = here.groupBy("path", "kind").agg(F.count("*").alias("n"))
    while True:
        fields = here.where("kind = 'object'").select("path", F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("k", "v"))
        items = here.where("kind = 'array'").select(F.concat("path", F.lit("[*]")).alias("path"), F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))
        below = fields.select(F.concat("path", F.lit("."), "k").alias("path"), "v").unionByName(items)
        here = checkpointed(below.withColumn("kind", _kind(F.col("v"))))
        if here.isEmpty():
            return out
        out = out.unionByName(here.groupBy("path", "kind").agg(F.count("*").alias("n")))
