"""Registered queries of this package and their SQL texts."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: module and query of every numbered operator
OPERATORS = {
    "op1_pii_surrogates": "surrogates",
    "op2_substring_dedup": "substrings",
    "op3_language_id": "language",
    "op4_token_ids": "tokens",
    "op5_quality_rules": "quality",
    "op6_license_scan": "licenses",
    "op7_jaccard_join": "jaccard",
    "op8_mixing": "mixing",
    "op9_chat_format": "chat",
    "op10_decontamination": "decontamination",
    "op11_merkle_manifest": "merkle",
    "op12_suffix_array_dedup": "suffixes",
    "op13_conversation_trie": "trie",
}


def _modules():
    return {name: import_module(f"{__package__}.{module}") for name, module in OPERATORS.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(module, name) for name, module in _modules().items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE_SQL for name, module in _modules().items() if getattr(module, "ORACLE_SQL", None)}
