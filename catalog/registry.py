"""Registration of queries together with the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import RECIPES, oracle_view, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, fixture: str, oracle: str):
    """Register a function of one table; in the SQL, ``<view>`` stands for a dirty view."""

    def register(build: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(table(spark, sf_dir, fixture))

        QUERIES[name] = run
        ORACLES[name] = expand(oracle)
        return build

    return register


def expand(sql: str) -> str:
    for view in RECIPES:
        sql = sql.replace(f"<{view}>", oracle_view(view))
    return sql.strip()
