"""The corpus queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from flowloom.session import ship

_MODULES = {
    "op2_lm_scoring": "nce_language_model",
    "op5_suffix_array_dedup": "suffix_dedup",
    "op9_substring_dedup": "cover_dedup",
    "op8_benchmark_decontamination": "qgram_decontam",
    "op3_ngram_jaccard_join": "parity_join",
    "op1_quality_classifier": "attention_quality",
    "op4_document_fingerprints": "iblt_fingerprints",
    "op6_byte_level_bpe": "byte_bpe",
    "op7_token_counts": "piece_counts",
    "op10_secret_scans": "secret_scan",
    "op11_license_scans": "license_scan",
    "op12_filter_interaction_audit": "filter_audit",
    "op13_conversation_prefix_trie": "prefix_trie",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(module: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: import_module(f"flowloom.llm.{module}").query(ship(spark), sf_dir)

    return {name: run(module) for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"flowloom.llm.{module}"), "ORACLE_SQL", None) for name, module in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
