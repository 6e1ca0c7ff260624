"""Registry of the queries run on the driver's tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slicewarden.session import apply_runtime_conf, ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query builder; ``sql`` is its DuckDB twin (None when the
    operator has no SQL form and is checked against brute force in tests)."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            apply_runtime_conf(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run

    return deco
