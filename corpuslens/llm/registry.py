"""Queries of this subpackage: name -> plan over a folder of tables, and the same rows as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(plan: Query) -> Query:
        QUERIES[plan.__name__] = plan
        if sql is not None:
            ORACLE[plan.__name__] = sql
        return plan

    return add
