"""Registered queries: one per inventory group, each with its SQL oracle.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables (the raw
timeline is derived from ``events``; see ``kestrel.sources.fixture``).  Every
result goes through ``normalize`` (bigint / rounded double) so it compares
with the oracle's output rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.functions.output import normalize
from kestrel.session import apply_engine_conf

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_engine_conf(spark)
            return normalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def _load_all() -> None:
    # Importing the query modules fills the registries.
    from kestrel.plans import (  # noqa: F401
        queries_eda, queries_features, queries_hot, queries_models, queries_scoring, queries_seq,
        queries_timeline)
