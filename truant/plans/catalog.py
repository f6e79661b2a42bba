"""Registry of named queries: a Spark callable and, where the operator is
expressible in SQL, the DuckDB oracle text over the same driver tables."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = [
    "truant.plans.catalog_profile",
    "truant.plans.catalog_features",
    "truant.plans.catalog_sampling",
    "truant.plans.catalog_stats",
    "truant.plans.catalog_evaluate",
    "truant.plans.catalog_models",
    "truant.plans.catalog_io",
    "truant.plans.catalog_state",
]


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # day counts and date parts are defined in UTC, whatever session we get
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def all_oracle() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
