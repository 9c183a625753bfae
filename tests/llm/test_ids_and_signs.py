"""Ids beside nulls, control characters, number signs and repeated ids."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terraloom.llm import fingerprints, html_extract, langid, packing, piece_viterbi, pii, quality_fm, quality_rules, simhash, token_counts

WORD_BPE, BYTE_BPE, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
IDS = [2**60 + 1, None, 2**60 + 3]


@pytest.fixture(scope="module")
def big(spark):
    return spark.createDataFrame([(i, "to one of a kind", "en", "s", i) for i in IDS], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(2**60 + 1, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(
    "work",
    [
        lambda d, _: fingerprints.compare_with_edited(d),
        lambda d, _: piece_viterbi.round_trips(d, PIECES),
        lambda d, _: piece_viterbi.decode(piece_viterbi.encode(d, PIECES), PIECES),
        lambda d, _: simhash.near_duplicates(d),
        lambda d, _: packing.pack(d, WORD_BPE),
        lambda d, _: pii.find(d),
        lambda d, _: pii.mask(d),
        lambda d, y: quality_fm.classify(d, y),
        lambda d, y: quality_fm.score(d, quality_fm.train(d, y)),
        lambda d, y: quality_rules.apply_rules(d, y.where("quality = 1").select("doc_id")),
        lambda d, _: token_counts.count_tokens(d, BYTE_BPE),
        lambda d, _: langid.identify(d),
        lambda d, y: corpus_pipeline.personal_data(d.sparkSession, d, ""),
        lambda d, y: corpus_pipeline.packed(d.sparkSession, d, ""),
    ],
)
def test_large_ids_beside_a_null(big, labels, work):
    rows = work(big, labels).collect()
    assert {r["doc_id"] for r in rows} == set(IDS)
    if "component_id" in rows[0]:
        assert {r["component_id"] for r in rows} == {2**60 + 1}
    if "n_chars" in rows[0] and "predicted" in rows[0]:
        assert {r["n_chars"] for r in rows} == set(IDS)


def test_large_ids_of_one_kept_copy(big):
    assert [r.doc_id for r in simhash.keep_one(big).collect()] == [2**60 + 1]


def test_large_page_ids(spark):
    pages = spark.createDataFrame([(i, "http://a.example/x", "<p>text</p>") for i in IDS], "page_id long, url string, html string").coalesce(1)
    assert {r.page_id for r in html_extract.extract_pages(pages).collect()} == set(IDS)


def test_packing_spells_every_code_point(spark):
    """Alone, between letters and beside blanks, as the library has it."""
    from tokenizers import Tokenizer

    points = [chr(c) for c in range(0x3200)]
    texts = [t for c in points for t in (c, f"a{c}b", f"x {c} y", f"{c}{c}")] + [f"{a}{b}" for a in points[:0x30] + points[0x7E:0xA4] for b in points[:0x30] + points[0x7E:0xA4]]
    want = [e.ids for e in Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)]
    for size in (1, 997, len(texts)):
        coder = packing.RunIds(WORD_BPE)
        got = []
        for i in range(0, len(texts), size) if size > 1 else range(0x400):
            ids, ends = coder.encode(texts[i : i + size])
            begin = 0
            for to in ends.tolist():
                got.append(ids[begin:to].tolist())
                begin = to
        assert got == want[: len(got)]
    odd = spark.createDataFrame([(i, c) for i, c in enumerate("\0\x01\x1c\x1f\x7f")], "doc_id long, text string")
    assert {r.doc_tokens for r in packing.pack(odd, WORD_BPE).collect()} == {2}


def test_pipeline_stages_take_control_characters(spark):
    text = " ".join(f"w{i}\x1c\x00 \x7f" for i in range(60))
    docs = spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    from tokenizers import Tokenizer

    packed = corpus_pipeline.packed(spark, corpus_pipeline.personal_data(spark, docs, ""), "")
    assert packed.agg(F.sum("length")).head()[0] == len(Tokenizer.from_file(WORD_BPE).encode(text, add_special_tokens=False).ids) + 1


def test_signs_of_numbers_are_no_letters(spark):
    rows = [(i, f"the quick brown fox number {i}", "en") for i in range(1, 20)]
    docs = spark.createDataFrame([*rows, (50, "½ ¼", None), (51, "²", None), (52, "Ⅷ ①", None), (53, "_ 12", None), (54, "x²", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert [got[i] for i in (50, 51, 52, 53, 54)] == ["und"] * 4 + ["en"]


def test_repeated_ids_teach_once(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text")).repartition(4)
    docs = docs.union(spark.createDataFrame([(8, "other text")], docs.schema))
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    taught = []
    keep = quality_fm.fit
    quality_fm.fit = lambda rows, *a: taught.append(rows) or keep(rows, *a)
    try:
        quality_fm.train(docs, labels)
        quality_fm.train(docs.repartition(7), labels)
    finally:
        quality_fm.fit = keep
    assert [len(t) for t in taught] == [2, 2]
    assert taught[0] == taught[1]


@pytest.mark.parametrize("seed", range(40))
def test_pairs_do_not_depend_on_the_width(seed, monkeypatch):
    rng = random.Random(seed)

    def tree(depth: int) -> str:
        n = rng.randint(0, 9 if depth == 2 else 3)
        inner = "".join(tree(depth - 1) if depth and rng.random() < 0.7 else rng.choice(["a ", "b ", "c "]) for _ in range(n))
        tag = rng.choice(["p", "b", "div", "p"])
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(10):
        one, other = (html_extract.parse(tree(2) + tree(2) + tree(1)) for _ in range(2))
        found = []
        for wide in (0, 10**9):
            monkeypatch.setattr(html_extract, "WIDE", wide)
            found.append(html_extract.matched(one, other))
        assert found[0] == found[1]
