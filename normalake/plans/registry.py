"""All queries of the library but the llm subpackage's."""

from __future__ import annotations

from importlib import import_module

from normalake.plans.base import QUERIES, SQL

for _module in ("queries_read", "queries_text", "queries_ledger", "queries_check", "queries_more", "queries_documents", "queries_streams", "queries_sources", "queries_files"):
    import_module(f"normalake.plans.{_module}")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
