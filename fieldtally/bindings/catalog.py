"""Collects the registered queries of all modules."""

from __future__ import annotations

from fieldtally.bindings import (  # noqa: F401
    group_queries,
    join_queries,
    model_queries,
    plan_queries,
    report_queries,
    scalar_queries,
    scan_queries,
)
from fieldtally.bindings.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
