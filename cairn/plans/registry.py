"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; without ``sql`` where SQL cannot express it."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def write_in_order(rows: DataFrame, order: Column, parts: int, path: str) -> None:
    """Write rows in appends one after the other, so that a file stream takes them in the order of a number."""
    least, most = rows.select(order.alias("o")).agg(F.min("o"), F.max("o")).first()
    step = ((most or 0) - (least or 0)) // parts + 1
    for k in range(parts):
        own = (order >= (least or 0) + k * step) & (order < (least or 0) + (k + 1) * step)
        rows.where(own).coalesce(1).write.mode("append").parquet(path)
