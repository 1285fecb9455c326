"""Register of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetwarden.plans.tables import Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, tables: str = ""):
    """Register a query under its function's name.

    ``sql`` is the counterpart in DuckDB's dialect; ``tables`` names the derived tables it reads.
    """

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(tables, sql)
        return build

    return register
