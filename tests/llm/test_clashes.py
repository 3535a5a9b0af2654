"""Stages of the pipeline keep columns that are named like their own."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from lagjoin.llm import jaccard

NAMES = ("score", "fit", "lang_pred", "proportions", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
         "__row", "group_key", "key", "h", "c0", "spans")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stage_keeps_clashing_columns(spark, name, stage):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    named = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES])
    kept = stage(spark, named, SF_SMALL)
    assert kept.columns == named.columns
    rows = kept.collect()
    assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in NAMES)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stage(spark, docs, SF_SMALL).collect()}
    assert stage(spark, docs.limit(0), SF_SMALL).columns == docs.columns


def test_wanted_texts_by_shuffle_or_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sent = sorted(map(tuple, jaccard.join(docs).collect()))
    monkeypatch.setattr(jaccard, "MAX_WANTED", 0)
    assert sorted(map(tuple, jaccard.join(docs).collect())) == sent
