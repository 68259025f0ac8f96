"""The catalogue of queries: modules add (name, function, SQL) with register()."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("text_queries", "retrieval_queries", "index_queries", "compression_queries", "routing_queries", "refine_queries", "generation_queries", "agent_queries", "chain_queries", "wiki_queries", "protocol_queries", "file_queries")

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}
_loaded = False


def register(name: str, oracle: str | None = None):
    """Decorator: adds a query under its name, with DuckDB SQL where there is one."""

    def add(f: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = f
        if oracle is not None:
            _oracles[name] = oracle
        return f

    return add


def _load() -> None:
    global _loaded
    if not _loaded:
        for m in MODULES:
            importlib.import_module(f"corvid.plans.{m}")
        _loaded = True


def queries() -> dict[str, Query]:
    _load()
    return _queries


def oracle_sql() -> dict[str, str]:
    _load()
    return _oracles


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _queries["pl0_hybrid"](spark, sf_dir)
