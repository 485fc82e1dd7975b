"""The queries of this subpackage and the SQL that some of them are held against."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("quality_classifier", "quality_rules", "bpe", "token_files", "jaccard_join", "decontamination", "warc", "pii", "line_dedup", "unit_dedup", "simhash", "vector_codes", "hard_negatives")


def queries() -> dict:
    found = {k: f for m in _MODULES for k, f in import_module(f"veinloom.llm.{m}").QUERIES.items()}
    return found | {"pipeline": import_module("corpus_pipeline").run}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in import_module(f"veinloom.llm.{m}").ORACLES.items()}
