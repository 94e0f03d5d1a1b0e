"""Every named query: a callable (session, table folder) -> DataFrame, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import batch, landed, streams

Query = Callable[[SparkSession, str], DataFrame]


def _in_utc(run: Query) -> Query:
    def call(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, folder)

    call.__name__ = run.__name__
    call.__doc__ = run.__doc__
    return call


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (batch, landed, streams):
        for name, (run, _) in module.REGISTRY.entries.items():
            found[name] = _in_utc(run)
    return found


def oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for module in (batch, landed, streams):
        for name, (_, sql) in module.REGISTRY.entries.items():
            if sql is not None:
                found[name] = sql
    return found
