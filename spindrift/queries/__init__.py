"""Registered queries: each names a Spark job and, where one exists, equal ANSI SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindrift.session import prepare
from spindrift.sources.tables import Tables

_SECTIONS = (
    "scans", "projection", "joins", "aggregation", "windows", "sorting", "sets",
    "scalars", "subqueries", "merging", "quality", "governance", "streams", "jobs",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, tables)`` under ``name`` with its oracle text."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), Tables(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def load() -> tuple[dict, dict]:
    for section in _SECTIONS:
        importlib.import_module(f"spindrift.queries.{section}")
    return QUERIES, ORACLES
