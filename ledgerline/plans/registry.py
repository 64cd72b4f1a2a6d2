"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Queries that write tables do so in a fresh ``Workspace`` under the shared
folder (``spark.checkpoint.dir``) and return the final table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ensure_engine_conf

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_engine_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco




# Query modules register themselves on import.
from ledgerline.plans import q_jobs, q_landing, q_mart, q_ops, q_stream, q_tables, q_types  # noqa: E402,F401
