"""The pipeline's stages, each on what the one before kept."""

import pyarrow.parquet as pq

import corpus_pipeline as pipeline
from quill.llm import secrets
from tests.llm.test_operators import near_classes

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = pipeline.stored(stage(spark, docs, SF), name.replace(" ", "-"))
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "near copies":
            assert set(after) == {c for c, _ in near_classes(before.items()).values()}
        if name == "decontamination":
            assert not any(b in t for t in after.values() for b in bench)
        if name == "secrets":
            assert set(after) == set(before) and not any(secrets.pattern_spans(t) for t in after.values())
    assert pipeline.run(spark, SF).count() == docs.count()


def test_near_copies_keeps_different_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(4, a, 1), (4, b, 2), (4, b, 3), (5, b + " more", 4), (6, c, 5), (7, c, 6), (8, None, 7), (8, None, 8), (9, "", 9)]
    docs = spark.createDataFrame([(d, t, "en", "s", n) for d, t, n in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r.doc_id, r.text, r.n_chars) for r in pipeline.drop_near_copies(spark, docs.repartition(3), SF).filter("text is not null").collect())
    assert kept == [(4, a, 1), (5, b + " more", 4), (6, c, 5), (9, "", 9)]
    assert [r.doc_id for r in pipeline.drop_near_copies(spark, docs, SF).filter("text is null").collect()] == [8]


def test_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "a b c d e f", "en", "s", 11), (4, "a b c d e f", "en", "s", 11),
            (4, "a b c d e f", "en", "s", 11), (None, "z", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(pipeline.drop_near_copies(spark, docs, SF).collect(), key=str)
    assert [r.doc_id for r in kept] == [1, 2, 3, None]
    assert pipeline.drop_near_copies(spark, docs.limit(0), SF).count() == 0
    out = pipeline.redact_secrets(spark, docs, SF)
    assert out.columns == docs.columns and out.count() == len(rows)
