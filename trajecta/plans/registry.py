"""All queries of the reference operators."""

from __future__ import annotations

from trajecta.plans import common, draw_queries, row_queries, stats_queries, text_queries, vector_queries  # noqa: F401  (they register their queries)


def queries() -> dict:
    return dict(common.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(common.SQL)
