"""Query registry: each entry pairs a Spark plan with its DuckDB oracle SQL.

Both sides read the same driver tables; column names match exactly. Float
outputs are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module (each registers on import)."""
    from presswork.plans import q_cluster, q_combos, q_daily, q_day, q_pages, q_serving, q_site, q_sources, q_stream, q_summary  # noqa: F401
