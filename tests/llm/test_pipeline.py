"""The pipeline's stages: each one's decisions take effect on all that its predecessor kept."""

import corpus_pipeline
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out, base = [docs], tmp_path_factory.mktemp("stages")
    for name, f in corpus_pipeline.STAGES:
        f(spark, out[-1], SF_DIR).write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "pii", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_each_stage_takes_effect(spark, stages):
    from terraloom.llm import pii, quality_fm, quality_rules, simhash
    from terraloom.llm.frames import crc32_mod

    ids = [sorted(r.doc_id for r in df.select("doc_id").collect()) for df in stages[:-1]]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = quality_rules.apply_rules(stages[0], labels.where("quality = 1")).where("kept").select("doc_id").collect()
    assert ids[1] == sorted(r.doc_id for r in kept)
    m = quality_fm.train(stages[1], labels.where(crc32_mod("doc_id", 3) != 1))
    assert ids[2] == sorted(r.doc_id for r in quality_fm.score(stages[1], m).where("predicted = 1").select("doc_id").collect())
    assert ids[3] == sorted({r.component_id for r in simhash.near_duplicates(stages[2]).collect()})
    assert ids[4] == ids[3]
    for r in stages[4].collect():
        assert pii.base_spans(r.text) == []
        assert r.n_chars == len(r.text)
    assert sorted({r.doc_id for r in stages[5].collect()}) == ids[4]


def test_clean_documents_stay(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    text = {r.doc_id: r.text for r in stages[0].collect()}
    good = [i for i, q in labels.items() if q == 1 and len(text[i].split()) >= 50]
    left = {r.doc_id for r in stages[2].collect()}
    assert sum(i in left for i in good) >= 0.98 * len(good)


def test_run_equals_its_stages(spark, stages):
    a = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted({r.doc_id for r in a}) == sorted({r.doc_id for r in stages[5].collect()})


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(None, text(1), "a"), (None, text(2), "a"), (None, text(2), "b"), (5, text(3), "a"), (5, text(3), "a"), (5, text(4), "a"), (None, text(4), "a"), (9, text(5), "a"), (2**60 + 1, text(5), "b")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(0, text(1)), (0, text(2)), (5, text(3)), (5, text(4)), (9, text(5))])


def test_stages_on_nulls_repeats_empty_texts_and_clashing_names(spark):
    good = spark.read.parquet(f"{SF_DIR}/documents.parquet").join(spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").select("doc_id"), "doc_id").orderBy("doc_id").limit(20).collect()
    long = max((r.text for r in good), key=len)
    rows = [(r.doc_id, r.text, r.lang, r.source, len(r.text)) for r in good]
    rows += [(None, rows[0][1] + " tail", None, None, None), (None, None, "en", "s", None), (7_000_001, "", "en", "s", 0), rows[3], rows[3], (7_000_002, (long + " ") * 50, "en", "s", 1)]
    extra = "key string, rank int, given string, words int, score double, text__ string"
    docs = spark.createDataFrame([(*r, "k", 1, "g", 2, 0.5, "t") for r in rows], f"doc_id long, text string, lang string, source string, n_chars int, {extra}")
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        counts[name] = out.count()
        if name != "packing":
            assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name
    assert counts["pii"] == len(rows)
    assert counts["quality_rules"] <= len(rows) - 2
    assert counts["packing"] >= len(rows)
    assert counts["simhash_near_dedup"] < len(rows)
