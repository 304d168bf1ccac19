"""Queries of the training-data operators: one ``opN_<name>`` for each, over its whole table, and their SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = {
    "op1_mixing": "mixing",
    "op2_html_extraction": "html_extract",
    "op3_language_id": "langid",
    "op4_near_dedup": "near_dedup",
    "op5_substring_dedup": "substring_dedup",
    "op6_line_dedup": "line_dedup",
    "op7_decontamination": "decontam",
    "op8_pii": "pii",
    "op9_lpt_sharding": "sharding",
    "op10_topk_search": "topk",
    "op11_collocations": "collocations",
    "op12_periodic_runs": "runs",
    "op13_exact_dedup": "exact_dedup",
}


def queries() -> dict:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"{__package__}.{module}"), "ORACLE_SQL", None) for name, module in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
