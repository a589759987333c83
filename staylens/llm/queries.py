"""The contract queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

#: query name -> module that defines it (and ORACLE, where SQL can express it).
MODULES = {
    "op1_tool_calls": "tool_calls",
    "op9_html_text": "html_crf",
    "op5_substring_dedup": "substring_dedup",
    "op4_near_dup": "near_dup",
    "op3_toxicity": "toxicity",
    "op10_bpe": "bpe",
    "op2_warc": "warc",
    "op6_decontamination": "decontaminate",
    "op7_line_quality": "line_quality",
    "op8_url_filter": "url_filter",
    "op11_collocations": "collocations",
    "op12_language_id": "language_id",
    "op13_periodic_runs": "periodic_runs",
}


def queries() -> dict:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict:
    modules = {name: import_module(f"{__package__}.{module}") for name, module in MODULES.items()}
    return {name: m.ORACLE for name, m in modules.items() if getattr(m, "ORACLE", None)}
