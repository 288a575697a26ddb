"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = {
    "op1_language_id": "langid",
    "op2_url_filter": "urls",
    "op3_pii": "pii",
    "op4_exact_dedup": "exact_dedup",
    "op5_toxicity": "toxicity",
    "op6_best_fit_packing": "packing",
    "op7_sharding": "sharding",
    "op8_license_scan": "licenses",
    "op9_decontamination": "decontaminate",
    "op10_near_dedup": "near_dedup",
    "op11_fill_in_middle": "fill_in_middle",
    "op12_collocations": "collocations",
    "op13_suffix_dedup": "suffix_dedup",
}


def queries() -> dict:
    return {name: import_module(f"normalake.llm.{module}").query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"normalake.llm.{module}"), "SQL", None) for name, module in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
