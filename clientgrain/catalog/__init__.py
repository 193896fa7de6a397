"""Every operator as a query on the test tables, with the same result in SQL.

``QUERIES`` maps a name to ``(spark, folder) -> DataFrame``; ``SQL`` holds the
equivalent statement where one exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)
        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = sql
        return build
    return register


def load() -> None:
    from . import features, histories, profiles, scores, samples, encoding, names, models, storage, streams  # noqa: F401
