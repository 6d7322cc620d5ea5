"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat_render,
    co_training,
    dart_minhash,
    decontaminate,
    divergence,
    flow_reshard,
    html_extract,
    license_index,
    line_rules,
    oracle,
    rank_bpe,
    secret_grammar,
    token_align,
    trie_bpe,
)
from .common import table


def tokenizer_path() -> str:
    """The public vocabulary that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def rank_file() -> tuple[str, str]:
    """The rank file and the pattern that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.page_rows(table(spark, sf_dir, "pages"))


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.class_rows(table(spark, sf_dir, "documents"))


def op3_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co_training.quality_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.license_rows(table(spark, sf_dir, "documents"))


def op5_seed_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_grammar.secret_rows(table(spark, sf_dir, "documents"))


def op7_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.bpe_rows(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_render.chat_rows(table(spark, sf_dir, "conversations"))


def op9_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_reshard.shard_rows(table(spark, sf_dir, "documents"))


def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_rules(table(spark, sf_dir, "documents"))


def aligned_paths() -> tuple[str, str]:
    """The two vocabularies that the contract names, A and B."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_rows(table(spark, sf_dir, "documents"), *aligned_paths())


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.rank_rows(table(spark, sf_dir, "documents"), *rank_file())


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_site_templates": op1_site_templates,
        "op2_dart_minhash": op2_dart_minhash,
        "op3_co_training": op3_co_training,
        "op4_license_scan": op4_license_scan,
        "op5_seed_align": op5_seed_align,
        "op6_secret_grammar": op6_secret_grammar,
        "op7_trie_bpe": op7_trie_bpe,
        "op8_chat_render": op8_chat_render,
        "op9_flow_reshard": op9_flow_reshard,
        "op10_line_rules": op10_line_rules,
        "op11_token_align": op11_token_align,
        "op12_source_divergence": op12_source_divergence,
        "op13_rank_bpe": op13_rank_bpe,
    }


def all_oracles() -> dict[str, str]:
    return {
        "op4_license_scan": oracle.license_scan(),
        "op8_chat_render": oracle.chat_render(),
        "op10_line_rules": oracle.line_rules(),
        "op12_source_divergence": oracle.source_divergence(),
    }
