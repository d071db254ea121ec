"""Registry of runnable queries: one entry per operator of the inventory.

Each entry pairs a Spark plan builder ``fn(spark, sf_dir) -> DataFrame`` with,
where the operator is expressible in SQL, the equivalent DuckDB SQL over the
driver's tables (fixtures inlined as CTEs)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` with an optional oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the modules fills the registry.
    from tablerail.plans import q_control, q_reads, q_runs, q_text, q_writes  # noqa: F401
    return REGISTRY
