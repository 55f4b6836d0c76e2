import re

import pytest

import corpus_pipeline
from aerostrata.llm import mixing
from test_duplicates import classes_by_brute_force, leaks_by_brute_force
from test_store_and_mix import encoded

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append({r.doc_id: r for r in docs.collect()})
        if i < 4:
            assert docs.columns == columns
    whole = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert 0.5 * len(whole) < len(kept[0]) < len(whole)
    classes = classes_by_brute_force([(i, r.text) for i, r in kept[0].items()])
    assert set(kept[1]) == set(classes.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, *_ in leaks_by_brute_force([(i, r.text) for i, r in kept[1].items()], items)}
    assert set(kept[2]) == set(kept[1]) - bad
    assert all(kept[2][i] == whole[i] for i in kept[2])
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in kept[2].values())
    assert sum(len(r.text.split()) for r in kept[3].values()) == pytest.approx(1.5 * words, rel=0.1)
    assert all(len(r.text.split()) <= corpus_pipeline.BLOCK_WORDS for r in kept[3].values())
    want = encoded([(i, r.text) for i, r in kept[3].items()])
    assert sorted(tuple(r)[:4] for r in kept[4].values()) == [w[:4] for w in want]
    assert mixing.BLOCK_WORDS < corpus_pipeline.BLOCK_WORDS


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.count() == 0


def test_odd_documents(spark, odd, odd_rows, tmp_path):
    """Nulls, repeats, ties, long texts and clashing columns through every stage."""
    docs, kept = odd, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs.collect())
    texts = {r[1] for r in odd_rows}
    assert all(r.text in texts for stage in kept[:3] for r in stage)
    assert len(kept[0]) >= len(kept[1]) >= len(kept[2])
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in kept[2])
    assert sum(len(r.text.split()) for r in kept[3]) == pytest.approx(1.5 * words, rel=0.1, abs=2 * corpus_pipeline.BLOCK_WORDS)
    assert len(kept[4]) == len(kept[3])
