"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import packing, pii, quality_fm, quality_rules, simhash
from terraloom.llm.frames import crc32_mod
from terraloom.llm.queries import tokenizer_path, trusted_ids
from terraloom.session import prepare, read, shared_dir
from terraloom.sinks.publish import remove

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts are among them. Repeated rows go or stay together;
    a null id is never a trusted one. An empty table: no rows."""
    return quality_rules.apply_rules(docs, trusted_ids(prepare(spark), sf_dir)).where("kept").select(*docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Labels of held-out ids are not learned from. A null text counts as
    empty, a null id teaches nothing, repeated rows go or stay together; without labels all stay."""
    labels = read(prepare(spark), sf_dir, "labels").where(crc32_mod("doc_id", 3) != 1)
    return quality_fm.score(docs, quality_fm.train(docs, labels)).where("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest id; null ids come last, none is lost for it."""
    return simhash.keep_one(docs).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to marks; n_chars follows the text. Null texts stay null, as does their n_chars; no row goes."""
    out = pii.mask(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row a piece. A null or empty text is its end mark alone; repeated rows and null ids are packed like
    any other."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packed),
]

#: The classifier, the random field and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read again by the next, and goes when the next
    one stands. Columns of `documents` beside COLUMNS are not carried along. An empty table gives no rows."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    base = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before:
            remove(spark, before)
        before = f"{base}/{name}"
    return docs
