"""The query registry: a Spark plan per operator and the matching SQL.

``@query(name, sql)`` registers a function that takes a ``Catalog`` and returns a
DataFrame.  Tables named in the SQL that are fixtures become common table expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Catalog, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Catalog], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Catalog(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return build

    return register
