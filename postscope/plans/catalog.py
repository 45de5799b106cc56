"""Registry of the queries the driver runs, each with its DuckDB twin.

Every query reads whole driver tables through an adapter
(``postscope.sources.adapters``) and runs one operator or question of the
inventory on all of it. ``ORACLE_SQL`` holds the equivalent DuckDB SQL over
the same tables; a query with no SQL twin is simply absent from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postscope.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

K = 10


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return A.load(spark, sf, name)


def events_posts(spark, sf):
    return A.events_posts(load(spark, sf, "events"))


def orders_posts(spark, sf):
    return A.orders_posts(load(spark, sf, "orders"), load(spark, sf, "customer"))


def lineitem_posts(spark, sf):
    return A.lineitem_posts(load(spark, sf, "lineitem"), load(spark, sf, "supplier"))


def lineitem_line_posts(spark, sf):
    return A.lineitem_line_posts(load(spark, sf, "lineitem"), load(spark, sf, "supplier"))


def documents_posts(spark, sf):
    return A.documents_posts(load(spark, sf, "documents"))


def documents_records(spark, sf):
    return A.documents_records(load(spark, sf, "documents"))


def event_lines(spark, sf):
    return A.events_json_lines(load(spark, sf, "events"))


# Importing the query modules fills the registry.
from postscope.plans import catalog_questions  # noqa: E402,F401
from postscope.plans import catalog_profiles  # noqa: E402,F401
from postscope.plans import catalog_files  # noqa: E402,F401
from postscope.plans import catalog_summaries  # noqa: E402,F401
from postscope.plans import catalog_parity  # noqa: E402,F401
