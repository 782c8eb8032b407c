"""The registered queries of this package, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from extracteval.llm import chat, phrases, quality, spelling, suffix_dedup
from extracteval.llm.block_search import nearest
from extracteval.llm.common import read
from extracteval.llm.decontamination import find_leaks
from extracteval.llm.packing import pack_documents
from extracteval.llm.pii import personal_data
from extracteval.llm.sharding import shard_documents
from extracteval.llm.simhash import simhash_components
from extracteval.llm.token_files import token_files_query
from extracteval.llm.toxicity import score_documents

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op1_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))


def op2_contextual_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))


def op3_vbyte_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_query(read(spark, sf_dir, "documents"), BYTE_BPE)


def op4_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(read(spark, sf_dir, "conversations"))
    return chat.digest_conversations(chat.format_conversations(spark, rows))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), WORD_BPE)


def op7_block_matrix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


def op8_toxic_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op11_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")))


def op13_trie_frontier_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_label_propagation_shards, op2_contextual_personal_data, op3_vbyte_token_files, op4_additive_quality,
        op5_event_sourced_chat, op6_best_fit_packing, op7_block_matrix_search, op8_toxic_clause_grammar,
        op9_qgram_decontamination, op10_covering_simhash, op11_son_phrases,
        op12_suffix_array_dedup, op13_trie_frontier_spelling,
    )
}
ORACLE: dict[str, str] = {
    "op5_event_sourced_chat": chat.ORACLE_SQL, "op11_son_phrases": phrases.ORACLE_SQL,
    "op12_suffix_array_dedup": suffix_dedup.ORACLE_SQL, "op13_trie_frontier_spelling": spelling.ORACLE_SQL,
}
