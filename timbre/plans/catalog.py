"""Registry of the driver queries and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of (spark, sf_dir) and, where SQL can express it, its SQL."""

    def register(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


from timbre.plans import clip_queries, record_queries, run_queries, shard_queries, signal_queries, stage_queries, table_queries  # noqa: E402, F401  they register themselves
