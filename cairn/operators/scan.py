"""Keyed reads and filtered, ordered scans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def in_table_order(df: DataFrame, wanted: Sequence[str] | None) -> list[str]:
    """Wanted columns in the table's order, each once."""
    if wanted is None:
        return df.columns
    if missing := [c for c in wanted if c not in df.columns]:
        raise ValueError(f"no such columns: {missing}")
    return [c for c in df.columns if c in set(wanted)]


def get(df: DataFrame, keys: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """A row for each request: its key and the columns of the row with that key, null if there is none.

    Requests may repeat and each is answered. A request with a null in its key is
    an error. Which side is broadcast, if any, is left to run-time statistics.
    """
    wanted = in_table_order(df, None if columns is None else [*key, *columns])
    asked = keys.select(*[F.coalesce(F.col(k), F.raise_error(F.lit(f"key column {k} is null")).cast(keys.schema[k].dataType)).alias(k) for k in key])
    return asked.join(df.select(*wanted), list(key), "left").select(*wanted)


def get_values(spark: SparkSession, df: DataFrame, key: Sequence[str], values: Sequence[Sequence[Any]], columns: Sequence[str] | None = None) -> DataFrame:
    """``get`` for keys given in the program; a short list also reaches the scan as a filter."""
    if any(v is None for row in values for v in row):
        raise ValueError("key values must not be null")
    keys = spark.createDataFrame([tuple(v) for v in values], df.select(*key).schema)
    if len(values) <= 1000:
        for i, k in enumerate(key):
            df = df.where(F.col(k).isin([v[i] for v in values]))
    return get(df, keys, key, columns)


def members(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is among the given ones."""
    return df.join(keys.select(*key), list(key), "left_semi")


def condition(equal: dict[str, Any] | None = None, between: dict[str, tuple[Any, Any]] | None = None) -> Column | None:
    """Conjunction of ``col = value`` and half-open ranges ``[start, stop)``; a range may be open on one side."""
    parts: list[Column] = []
    for name, value in (equal or {}).items():
        if value is None:
            raise ValueError(f"the value for {name} is null")
        parts.append(F.col(name) == F.lit(value))
    for name, (start, stop) in (between or {}).items():
        if start is None and stop is None:
            raise ValueError(f"the range for {name} has no bound")
        if start is not None:
            parts.append(F.col(name) >= F.lit(start))
        if stop is not None:
            parts.append(F.col(name) < F.lit(stop))
    return reduce(lambda a, b: a & b, parts) if parts else None


def scan(
    df: DataFrame, equal: dict[str, Any] | None = None, between: dict[str, tuple[Any, Any]] | None = None,
    columns: Sequence[str] | None = None, sort: Sequence[str] | None = None, limit: int | None = None,
) -> DataFrame:
    """Filtered scan; ``sort`` names key columns, always ascending with nulls last (suffixes ``:asc``, ``:desc`` are ignored)."""
    wanted = condition(equal, between)
    out = df if wanted is None else df.where(wanted)
    if sort:
        names = [s.rsplit(":", 1)[0] if s.endswith((":asc", ":desc")) and s not in df.columns else s for s in sort]
        out = out.orderBy(*[F.col(f"`{n}`").asc_nulls_last() for n in names])
    if limit is not None:
        out = out.limit(limit)
    return out.select(*in_table_order(df, columns))


def cursor(df: DataFrame, prefetch: bool = True) -> Iterator[Row]:
    """Forward-only iterator; holds one partition at a time."""
    return df.toLocalIterator(prefetchPartitions=prefetch)


def query(spark: SparkSession, text: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A query as a source, projected."""
    found = spark.sql(text)
    return found if columns is None else found.select(*columns)
