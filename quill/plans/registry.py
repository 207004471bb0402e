"""Named queries over the test tables: a Spark plan plus, where SQL can say the
same thing, the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    from quill.plans import (q_search, q_text, q_index, q_headers,  # noqa: F401
                             q_changelog, q_ownership, q_answers, q_files)
    return REGISTRY
