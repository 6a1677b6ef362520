"""Columns of any name and type pass the pipeline's stages unchanged."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kpi_lake.llm import decontam

SF = "/root/testdata/sf0.001"
ODD = {
    "__k1": "concat('mine', doc_id)",
    "__k2": "doc_id * 3",
    "__n": "5",
    "__noise": "'loud'",
    "__row": "2.5D",
    "k1": "array(1, null)",
    "c0": "named_struct('a b', doc_id, 'c:d', 'x', 'e', named_struct('f-g', 1))",
    "packed": "map('k', doc_id)",
    "two words": "date'2020-01-01'",
}


@pytest.fixture(scope="module")
def odd(spark):
    docs = corpus_pipeline.read_table(spark, SF, "documents")
    return docs.select("*", *[F.expr(c).alias(n) for n, c in ODD.items()])


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES[:-1]])
def test_a_stage_hands_them_through(spark, odd, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    got, plain = run(spark, odd, SF), run(spark, odd.select("doc_id", "text", "lang", "source", "n_chars"), SF)
    assert got.columns == odd.columns and [f.dataType for f in got.schema] == [f.dataType for f in odd.schema]
    assert {r.doc_id: r.text for r in got.collect()} == {r.doc_id: r.text for r in plain.collect()}
    given = {r.doc_id: r for r in odd.drop("text", "n_chars").collect()}
    assert all(given[r.doc_id] == r for r in got.drop("text", "n_chars").collect())


def test_decontamination_in_parts(spark, odd):
    benchmark = corpus_pipeline.read_table(spark, SF, "benchmark")
    whole = decontam.remove_contaminated(odd, benchmark)
    parts = decontam.remove_contaminated(odd, benchmark, max_broadcast_bytes=1000)
    assert parts.columns == odd.columns and sorted(r.doc_id for r in parts.select("doc_id").collect()) == sorted(r.doc_id for r in whole.select("doc_id").collect())
