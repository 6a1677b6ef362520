"""Registered queries of this subpackage: thin digests of its operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.llm import bpe, chat, dac, decontam, minhash, repetition, resample, suffix_dedup, suffix_tree, treap, urls, variants, warc
from kpi_lake.llm.common import read_table, scratch_path


def vocabulary_path() -> str:
    """The default vocabulary file of the BPE query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(read_table(spark, sf_dir, "documents"), depth=suffix_tree.DEPTH).withColumnRenamed("id", "doc_id")


def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_decode(read_table(spark, sf_dir, "documents"), vocabulary_path(), with_ids=False, with_text=False)
    return found.withColumnRenamed("id", "doc_id")


def op3_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judge_urls(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict", "score", "threshold")


def op5_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "covered_chars", "n_repeats", "longest_repeat",
    )


def op6_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), digests=True)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


#: A conversation that says the template's own control strings.
CONTROL_ROWS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op9_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = given.unionByName(spark.createDataFrame(CONTROL_ROWS, "conv_id bigint, turn bigint, role string, text string"))
    return chat.read_back(chat.render(chat.fold_events(chat.conversation_events(rows))))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "kept", "log_weight", "clean_weight", F.col("key").alias("sampling_key"))


def op11_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.count_words(read_table(spark, sf_dir, "documents"), typo_every=199))


def op12_k2_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = treap.search(treap.build_index(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("query").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op13_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_ids")
    dac.write_tokens(read_table(spark, sf_dir, "documents"), folder, vocabulary_path())
    return dac.read_documents(spark, folder, with_ids=False).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_bpe_automaton": op2_bpe_automaton,
    "op3_warc_shards": op3_warc_shards,
    "op4_url_model": op4_url_model,
    "op5_suffix_repetition": op5_suffix_repetition,
    "op6_bbit_minhash": op6_bbit_minhash,
    "op7_suffix_sort": op7_suffix_sort,
    "op8_decontaminate": op8_decontaminate,
    "op9_chat_events": op9_chat_events,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_frequency_trie": op11_frequency_trie,
    "op12_k2_treap": op12_k2_treap,
    "op13_direct_codes": op13_direct_codes,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from kpi_lake.llm import oracle

    return {k: v for k, v in oracle.ORACLE.items() if k in QUERIES}
