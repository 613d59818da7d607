"""The registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    from sessionflow.plans import catalog, events, profiles, recommendations, sessions, stateful, streams

    return (events, sessions, recommendations, catalog, profiles, streams, stateful)


def _in_utc(query: Query) -> Query:
    """The driver's times carry no zone; read them as UTC whatever the session's zone is."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    return {name: _in_utc(query) for module in _modules() for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
