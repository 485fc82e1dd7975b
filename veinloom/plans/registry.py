"""All queries for the operators of the reference, on the given tables."""

from __future__ import annotations

from veinloom.plans import base, domain_queries, file_queries, load_queries, model_queries, relational_queries, source_queries, text_queries  # noqa: F401  (they register themselves)


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.ORACLES)
