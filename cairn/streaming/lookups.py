"""Lookups of a stream in a keyed table that changes meanwhile.

Each micro-batch meets the dimension as it is when the batch starts, and reads only the
buckets of its own keys. Keys that are missing can be added with the next serial ids; a batch
that comes again finds those it has added before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairn import store
from cairn.operators import lookup
from cairn.sources.keyed_table import KeyedTable
from cairn.streaming.sinks import _started, _writer


def enriched(batch: DataFrame, dim: KeyedTable, on: dict[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """The batch with the columns of the dimension's rows of its keys; ``on`` maps the batch's columns to the key."""
    if sorted(on.values()) != sorted(dim.key):
        raise ValueError(f"a lookup by bucket needs the whole key {dim.key}")
    version = dim.version()
    keys = batch.select(*[F.col(f).alias(d) for f, d in on.items()]).na.drop()
    return lookup.lookup(batch, dim._stored(version, dim._touched(keys, version)), on, columns)


def insert_missing(batch: DataFrame, dim: KeyedTable, on: dict[str, str], serial: str, checkpoint: str, batch_id: int) -> None:
    """Add the batch's keys that the dimension lacks, with the serial ids after the largest one, in key order."""
    version = dim.version()
    keys = batch.select(*[F.col(f).alias(d) for f, d in on.items()]).na.drop()
    new = lookup.missing_keys(batch, dim._stored(version, dim._touched(keys, version)), on)
    largest = dim.read().agg(F.coalesce(F.max(serial), F.lit(0)).cast("long")).first()[0]
    rows = lookup.dense_ids(new, list(on.values()), largest, serial).withColumn("_seq", F.lit(0))
    dim.merge(rows, once=_writer(batch, checkpoint, batch_id), mode="ignore")


def lookup_stream(
    stream: DataFrame, dim: KeyedTable, on: dict[str, str], step: Callable[[DataFrame, int], None], checkpoint: str,
    columns: Sequence[str] | None = None, serial: str | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Hand every micro-batch, joined with the dimension, to ``step``; with ``serial`` its missing keys are added first."""

    def take(batch: DataFrame, batch_id: int) -> None:
        if serial:
            insert_missing(batch, dim, on, serial, checkpoint, batch_id)
        step(enriched(batch, dim, on, columns), batch_id)

    return _started(stream.writeStream.foreachBatch(take), checkpoint, available_now)


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A step that writes each micro-batch to a folder of its own, anew where it comes again."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")


def written(like: DataFrame, path: str) -> DataFrame:
    """What ``to_folder`` has written."""
    spark = like.sparkSession
    return spark.read.schema(like.schema).parquet(path).select(*like.columns) if store.names(spark, path) else spark.createDataFrame([], like.schema)
