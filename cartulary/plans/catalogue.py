"""Every query over the analytics tables, by name."""

from __future__ import annotations

from cartulary.plans import group_queries, path_queries, report_queries, source_queries, split_queries, value_queries  # noqa: F401  (they register)
from cartulary.plans.base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
