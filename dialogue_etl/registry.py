"""The queries of the dialogue corpus jobs and their SQL."""

from __future__ import annotations

from dialogue_etl.plans import line_queries, page_queries, scalar, shared  # noqa: F401  (the modules register their queries)


def queries() -> dict:
    return dict(shared.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(shared.SQL)
