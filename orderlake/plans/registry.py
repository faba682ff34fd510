"""Registry of named queries: a Spark plan and its DuckDB oracle.

Each entry maps a name to ``fn(tables) -> DataFrame`` and, where the result
is expressible in SQL, the oracle SQL text (adapter CTEs + body).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.testdata import StoredTables, Tables
from .adapter_sql import with_adapter

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# Queries whose feature needs new orders: the base holds nine in ten of the
# driver's orders, the rest arrive as New-Order requests. All others read all.
SPLIT: set[str] = set()

_TABLES_CACHE: dict[tuple, Tables] = {}


def register(name: str, sql: str | None = None, split: bool = False):
    def deco(fn):
        QUERIES[name] = fn
        if split:
            SPLIT.add(name)
        if sql is not None:
            ORACLE[name] = with_adapter(sql, split)
        return fn
    return deco


def tables_for(spark: SparkSession, sf_dir: str, split: bool = False) -> Tables:
    """The tables of a data set, stored once an application: a new session never gets those of a dead one."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), split)
    if key not in _TABLES_CACHE or _TABLES_CACHE[key].lost():
        _TABLES_CACHE[key] = StoredTables(spark, sf_dir, split)
    return _TABLES_CACHE[key]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](tables_for(spark, sf_dir, name in SPLIT))
