"""The subpackage's queries and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from importlib import import_module

#: query name -> module of this subpackage; each module has a function of the query's name and, where SQL can express it, its SQL in ``ORACLE_SQL``.
MODULES = {
    "op2_sentencepiece_samples": "pieces",
    "op1_line_dedup": "lines",
    "op9_html_extract": "html",
    "op4_warc_revisits": "warc",
    "op7_packing": "packing",
    "op5_exact_top_k": "topk",
    "op3_chat_format": "chat",
    "op10_substring_dedup": "substring",
    "op8_simhash_near_dedup": "simhash",
    "op6_quality_rules": "quality",
    "op11_language_id": "languages",
    "op12_source_divergence": "divergence",
    "op13_centroid_clusters": "centroids",
}


def queries() -> dict:
    return {name: getattr(import_module(f"kinfold.llm.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"kinfold.llm.{module}"), "ORACLE_SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
