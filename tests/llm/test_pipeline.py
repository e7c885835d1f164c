"""The pipeline's stages with nulls, repeated ids, equal rows, empty tables and columns of clashing names."""

import random

import pytest

from comboscope.llm import jaccard

SCHEMA = "doc_id long, text string, lang string, document_key int, id_key int, text_key string, replaced_count int, n_chars long"
SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", 7, 8, "k", 9, len(t or "")) for d, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    return [" ".join(rng.choices(words, k=80)) for _ in range(5)]


def test_texts_of_a_repeated_id_are_documents_of_their_own(spark, texts):
    import corpus_pipeline

    a, b, c, d, e = texts
    near = lambda t, n=1: t + " tail" * n
    rows = [(1, a), (1, b), (2, near(a)), (2, c), (3, near(b)), (3, d), (3, d), (None, near(c)), (None, e), (4, None), (5, ""), (5, ""), (6, None), (None, None)]
    got = corpus_pipeline.distinct_texts(spark, table(spark, rows).repartition(3), "")
    assert got.columns == table(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(1, a), (1, b), (2, c), (3, d), (None, e), (4, None), (5, ""), (6, None), (None, None)], key=repr)
    assert {r.document_key for r in got.collect()} == {7}


def test_stages_keep_columns_they_do_not_know(spark, texts):
    import corpus_pipeline

    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = table(spark, [(1, texts[0] + " " + item), (2, texts[1] + " mail joe@example.com"), (None, None), (3, None), (3, "")])
    clean = corpus_pipeline.without_benchmark(spark, docs, SF)
    assert clean.columns == docs.columns and sorted((r.doc_id or 0, r.id_key, r.text_key) for r in clean.collect()) == [(0, 8, "k"), (2, 8, "k"), (3, 8, "k"), (3, 8, "k")]
    out = corpus_pipeline.pseudonyms(spark, docs, SF)
    assert out.columns == docs.columns and {r.replaced_count for r in out.collect()} == {9}
    text = out.where("doc_id = 2").first()
    assert "joe@" not in text.text and text.n_chars == len(text.text)
    assert out.where("doc_id = 3").count() == 2


def test_stages_take_empty_tables(spark):
    import corpus_pipeline

    none = table(spark, [(1, "x")]).where("doc_id > 1")
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, none, SF).collect() == [], name
    kept = corpus_pipeline.good_quality(spark, table(spark, [(1, "x"), (None, None)]), SF)
    assert kept.columns == none.columns and kept.count() <= 2


def test_sets_of_parts_equal_sets_of_the_whole(monkeypatch, texts):
    import pyarrow as pa

    column = pa.array([*texts, None, "", "one", *texts[:2]], pa.large_string())
    whole = jaccard.shingle_sets(column, 3)
    for size in (1, 100, 1000):
        monkeypatch.setattr(jaccard, "MEETING_CHUNK", size)
        h, at = jaccard._sets_of(column, 3)
        assert (h == whole[0]).all() and (at == whole[1]).all()
