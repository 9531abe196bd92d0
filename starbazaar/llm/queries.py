"""The queries of this folder by name, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = {
    "op1_sentencepiece": "sentencepiece_bpe",
    "op2_toxicity": "toxicity_grammar",
    "op3_lines": "line_templates",
    "op4_links": "link_trust",
    "op5_pii": "pii_boosting",
    "op6_warc": "warc_index",
    "op7_simhash": "simhash_covering",
    "op8_quality": "quality_likelihood",
    "op9_sketch": "paragraph_sketch",
    "op10_mixing": "mixing",
    "op11_conversations": "conversation_trie",
    "op12_language": "language_centroids",
    "op13_runs": "periodic_runs",
}


def queries() -> dict[str, Query]:
    return {name: getattr(importlib.import_module(f"starbazaar.llm.{module}"), name) for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, module in _MODULES.items():
        sql = getattr(importlib.import_module(f"starbazaar.llm.{module}"), "ORACLE_SQL", None)
        if sql:
            found[name] = sql
    return found
