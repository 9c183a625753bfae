"""Quality rules: counts of each text, and a hashed n-gram log-likelihood ratio against a trusted target."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.frames import text_or_empty
from terraloom.session import unused

#: Buckets that one- and two-token grams are hashed to.
BUCKETS = 1 << 15
#: Weight of the raw corpus in the target's smoothing, as a share of the target's grams.
SMOOTHING = 0.01
#: A document is rejected if its mean log-likelihood ratio is below this.
THRESHOLD = -0.3

#: Words, symbols and the rule's limits.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def repeated_words(windows: Column) -> Column:
    """Words in windows of three that occur twice or more, from the windows' hashes in order. The hashes are sorted
    with their place in the low bits; neighbours that agree above them are confirmed on the whole hash, and the union
    of the windows found is measured along their places. A text whose hashes all differ is done at once."""
    n = F.size(windows)
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(n + 1.0)).cast("int")) - 1

    def measure(mask: Column) -> Column:
        above = F.bitwise_not(mask)

        def same(x: Column, y: Column) -> Column:
            place = lambda k: k.bitwiseAND(mask).cast("int")
            return x.bitwiseXOR(y).between(0, mask) & (F.get(windows, place(x)) == F.get(windows, place(y)))

        def places(keys: Column) -> Column:
            hit = F.filter(keys, lambda x, i: F.coalesce(same(x, F.get(keys, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(keys, i + 1)), F.lit(False)))
            return F.sort_array(F.transform(hit, lambda x: x.bitwiseAND(mask)))

        def length(at: Column) -> Column:
            return F.aggregate(
                F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(b - a, F.lit(3).cast("long"))),
                F.lit(0).cast("long"),
                lambda s, x: s + x,
            )

        keys = F.sort_array(F.transform(windows, lambda x, i: x.bitwiseAND(above).bitwiseOR(i.cast("long"))))
        return let(keys, lambda k: let(places(k), length))

    return F.when(F.size(F.array_distinct(windows)) == n, F.lit(0).cast("long")).otherwise(let(mask, measure))


def base_counts(text: Column, words: str) -> dict[str, Column]:
    """n_symbols, n_dup_lines, and under the name `words` struct<n, chars, repeat>, of a text that is not null."""

    def of_words(w: Column) -> Column:
        def windows(h: Column) -> Column:
            every = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
            return F.slice(every, 1, F.greatest(F.size(h) - 2, F.lit(0)))

        hashes = F.transform(w, lambda x: F.xxhash64(x))
        return F.struct(
            F.size(w).cast("long").alias("n"),
            F.char_length(F.array_join(w, "")).cast("long").alias("chars"),
            let(hashes, lambda h: let(windows(h), repeated_words)).alias("repeat"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        words: let(words_of(text), of_words),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def tokens_of(text: Column) -> Column:
    """Runs of letters and digits, and what follows them up to the next blank."""
    return F.split(text, r"(?<=[\p{L}\p{N}])(?=[^\p{L}\p{N}\s])|\s+")


def pair_with_next(tokens: Column, body) -> Column:
    """`body` of each token and the next; the last one's next is null, which hashes as the text's end."""
    return F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), body)


def gram_hashes(text: Column) -> Column:
    """Hashes of a text's tokens and of its pairs of neighbouring tokens."""
    return let(tokens_of(text), lambda t: F.concat(F.transform(t, lambda a: F.xxhash64(a)), pair_with_next(t, lambda a, b: F.xxhash64(a, b))))


def bucket_of(hashed: Column, buckets: int) -> Column:
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def mean_weight(text: Column, weights: Column, buckets: int) -> Column:
    """The mean of the weights of all grams."""
    weight = lambda h: F.get(weights, bucket_of(h, buckets))

    def mean(t: Column) -> Column:
        each = pair_with_next(t, lambda a, b: weight(F.xxhash64(a)) + weight(F.xxhash64(a, b)))
        return F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / (2 * F.size(t))

    return let(tokens_of(text), mean)


def gram_weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> list[float]:
    """ln p_target / p_raw by bucket, over all documents; `trusted` has the ids of the target's documents.

    One pass counts both multinomials, with partial sums before the shuffle; what comes to the driver is one row a
    bucket, whatever the input's size. Without trusted text all weights are 0.
    """
    # Always a merge join: how many ids are trusted grows with the input, so a broadcast would hold at small sizes only.
    good = trusted.select(id_col, F.lit(1).alias("good")).where(F.col(id_col).isNotNull()).distinct().hint("merge")
    counted = (
        docs.select(id_col, text_or_empty(text_col).alias("text"))
        .join(good, id_col, "left")
        .select(F.coalesce("good", F.lit(0)).alias("good"), F.explode(gram_hashes(F.col("text"))).alias("gram"))
        .groupBy(bucket_of(F.col("gram"), buckets).alias("bucket"))
        .agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
        .collect()
    )
    raw, target = sum(r.raw for r in counted), sum(r.target for r in counted)
    weights = [0.0] * buckets
    if target:
        prior = SMOOTHING * target
        for r in counted:
            p = r.raw / raw
            weights[r.bucket] = math.log((r.target + prior * p) / (target + prior) / p)
    return weights


def apply_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """All columns of `docs`, and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept.

    A document passes if it has 50 words or more, at most half of them in repeated windows, and a mean log-likelihood
    ratio (llr, per gram) of `threshold` or more; the threshold is the same for every document. Null or empty text:
    counts 0, base_failed. Without trusted ids the ratio is 0 for all. Columns of `docs` with the names of the
    result's give way to them. Repeated rows stay repeated.
    """
    weights = F.from_json(F.lit(json.dumps([round(w, 5) for w in gram_weights(docs, trusted, id_col, text_col, buckets)])), "array<double>")
    text = text_or_empty(text_col)
    named = {"n_words": "n", "word_chars": "chars", "n_repeat_words": "repeat"}
    words = unused(docs, "words")
    out = docs.withColumns(base_counts(text, words) | {"llr": mean_weight(text, weights, buckets)})
    out = out.withColumns({k: F.col(f"`{words}`.{v}") for k, v in named.items()}).drop(words)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
