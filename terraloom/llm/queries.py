"""The operators of this subpackage as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import alignment, fingerprints, html_extract, langid, negatives, packing, piece_viterbi, pii, quality_fm, quality_rules, simhash, token_counts, warc
from terraloom.session import prepare, read


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(prepare(spark), sf_dir, "documents")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edited(docs_of(spark, sf_dir))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read(prepare(spark), sf_dir, "pages"))


def op3_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_viterbi.round_trips(docs_of(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(docs_of(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(docs_of(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(docs_of(spark, sf_dir))


def op7_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(docs_of(spark, sf_dir), read(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(docs_of(spark, sf_dir), trusted_ids(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("llr", 6).alias("llr"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(docs_of(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(docs_of(spark, sf_dir))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(prepare(spark), sf_dir, "pages"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(docs_of(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read(prepare(spark), sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_fingerprints, op2_html_extraction, op3_piece_viterbi, op4_simhash, op5_packing, op6_pii, op7_quality_fm, op8_quality_rules, op9_token_counts, op10_langid, op11_warc, op12_alignment, op13_negatives)
}

#: The others can't be written in SQL that gives the same rows; each is tested against a brute-force version instead.
ORACLES: dict[str, str] = {
    "op11_warc": """
        WITH d AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
        SELECT page_id, url, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM f
    """,
    "op13_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
        n AS (
            SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
                CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other) AS INTEGER) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
}
