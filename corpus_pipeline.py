"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. Quality classifier: documents that importance resampling rejects go.
2. Near duplicates: of each group of documents linked by five-word shingles at a similarity of 0.8
   or more, the one with the smallest id stays.
3. Repeated passages: every byte covered by a string of 200 bytes that also starts elsewhere is cut;
   a document that the cut leaves without a word goes.
4. Benchmark decontamination: documents of which a twentieth of the words or more lies in windows of
   benchmark items go.
5. Encoding: the token ids of what is left.

All stages but the last return the columns of ``documents``; whatever a column holds, nulls
included, rows are judged as the stage's operator says, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.llm import bpe, decontam, minhash, queries, resample, suffix_dedup
from kpi_lake.llm.common import read_table, scratch_path, ship_package

NEAR_PERCENT = 80


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the classifier rejects go."""
    return resample.resample(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group stays."""
    del sf_dir
    ship_package(spark)
    return minhash.deduplicate(docs, percent=NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: repeated passages are cut from the texts."""
    del sf_dir
    ship_package(spark)
    cut = suffix_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: contaminated documents go."""
    return decontam.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token ids of every document that is left."""
    del sf_dir
    ship_package(spark)
    found = bpe.encode_decode(docs, queries.vocabulary_path(), with_ids=True, with_text=False)
    return found.withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", decontaminate),
    ("bpe_encoding", encode),
]

#: SQL expresses neither the classifier nor the encoding. Tests hold run() against its stages one by one,
#: and each stage's operator against plain code, as far as their files say.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
