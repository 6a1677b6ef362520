"""The pipeline's stages and what deleting the subpackage leaves."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import corpus_pipeline
import __spark_entry__ as entry
from kpi_lake.llm import bpe, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert names["pipeline"] is corpus_pipeline.run
    assert [f.__doc__.split(":")[0] for _, f in corpus_pipeline.STAGES] == [f"Operator {n}" for n in (10, 6, 7, 8, 2)]


def test_stages_chain_and_run_gives_the_last(spark):
    docs = given = corpus_pipeline.read_table(spark, SF, "documents")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), given.schema)
        assert docs.columns == given.columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    want = bpe.encode_decode(docs, queries.vocabulary_path(), with_text=False).collect()
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((r.id, r.ids_sha256, r.decoded_sha256) for r in want)


def test_empty_documents_pass_every_stage(spark):
    docs = corpus_pipeline.read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_the_rest_imports_without_the_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "kpi_lake"), tmp_path / "kpi_lake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(os.path.join(ROOT, "kpi_oracle"), tmp_path / "kpi_oracle")
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
