"""Registered queries: a Spark function over (spark, folder) and, where SQL can say the
same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factweave.sources.bridge import Tables, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, body: str | None = None, recursive: str = "", plain: bool = False):
    """Register a function of Tables under an inventory id. ``body`` is SQL over the
    bridge views, or over the raw tables alone if ``plain``."""

    def add(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if body is not None:
            ORACLE[name] = body.strip() if plain else sql(body, recursive)
        return function

    return add
