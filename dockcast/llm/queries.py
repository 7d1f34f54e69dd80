"""The operators bound to the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockcast.llm import bpe, chat, decontam, hyperminhash, langid, line_rules, max_sketch, mixing, rff_quality, rlbwt, secret_scan, superkmer, variants
from dockcast.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.dedup_words(table(spark, sf_dir, "documents")).drop("kept")


def op3_heap_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_suffix_array_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "matches")


def op5_rff_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rff_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_rlbwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlbwt.dedup_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("d", "h")


def op8_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op9_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(table(spark, sf_dir, "documents"))


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_vector_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = f"{chat.END}{chat.START}assistant ok"
    probe = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat.read_back(chat.format_chats(turns.unionByName(probe)))


def op13_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_sketch.search(max_sketch.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_superkmer_dedup": op2_superkmer_dedup,
    "op3_heap_bpe_tokens": op3_heap_bpe_tokens,
    "op4_suffix_array_decontam": op4_suffix_array_decontam,
    "op5_rff_quality": op5_rff_quality,
    "op6_rlbwt_dedup": op6_rlbwt_dedup,
    "op7_hyperminhash": op7_hyperminhash,
    "op8_entropy_secrets": op8_entropy_secrets,
    "op9_line_frequency": op9_line_frequency,
    "op10_cross_parsing": op10_cross_parsing,
    "op11_vector_trie_variants": op11_vector_trie_variants,
    "op12_chat_windows": op12_chat_windows,
    "op13_max_sketch_search": op13_max_sketch_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_pareto_mix": mixing.SQL,
    "op2_superkmer_dedup": superkmer.SQL,
    "op4_suffix_array_decontam": decontam.SQL,
    "op6_rlbwt_dedup": rlbwt.SQL,
    "op7_hyperminhash": hyperminhash.SQL,
    "op8_entropy_secrets": secret_scan.SQL,
    "op9_line_frequency": line_rules.SQL,
    "op11_vector_trie_variants": variants.SQL,
    "op12_chat_windows": chat.SQL,
    "op13_max_sketch_search": max_sketch.SQL,
}
