"""Registry of named queries: each entry is a Spark builder
``(spark, sf_dir) -> DataFrame`` plus, where the query is expressible in
SQL, the equivalent DuckDB query over the same Parquet tables.

Builders return the comparison form (``views.present``): doubles rounded to
six digits, timestamps as text.  The operators themselves return raw
types; rounding is applied only here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.plans.views import present

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from contrail.plans import q_drill, q_ingest, q_insight, q_kpi, q_lifecycle, q_ml, q_quality, q_store, q_trend  # noqa: F401
