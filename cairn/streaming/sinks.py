"""Stream sinks: change streams merged into keyed tables, and routing to many tables.

A micro-batch is merged whole, so a delete and the update that follows it become
visible together, and a batch that comes again after a failure is left out. Where a
micro-batch ends between the two, the delete is held until the update has come.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairn import store
from cairn.operators import changelog as cl
from cairn.sources.keyed_table import KeyedTable


def as_mutations(events: DataFrame, ignore_delete: bool = True, order: str = "_lsn") -> DataFrame:
    """Puts for inserts and after-images, deletes for deletes and before-images unless ignored."""
    kind = F.col("_event_type")
    kept = events.where(kind.isin(cl.INSERT, cl.AFTER_UPDATE) if ignore_delete else kind.isin(cl.INSERT, cl.AFTER_UPDATE, cl.DELETE, cl.BEFORE_UPDATE))
    op = F.when(kind.isin(cl.INSERT, cl.AFTER_UPDATE), "put").otherwise("delete")
    return kept.withColumns({"_op": op, "_seq": F.col(order)}).drop("_shard", "_lsn", "_event_type", "_ts_us")


class HeldDeletes:
    """Before-images that wait for their after-images, kept beside a stream's checkpoint, one folder a micro-batch.

    A before-image that is the last event of its key waits. It goes on once a later event of the key has come, or once
    its shard has gone on in ``patience`` further micro-batches without one: then the update has changed the key.
    A micro-batch that comes again starts from what was held before it.
    """

    def __init__(self, table: KeyedTable, folder: str, patience: int = 1) -> None:
        self.table, self.folder, self.patience = table, folder, patience

    def _of(self, batch_id: int) -> str:
        return f"{self.folder}/{batch_id}"

    def held(self, batch_id: int, like: DataFrame) -> DataFrame:
        """What waits after a micro-batch."""
        schema = like.select("*", F.lit(0).alias("_waited")).schema
        spark = like.sparkSession
        return spark.read.schema(schema).parquet(self._of(batch_id)) if store.names(spark, self._of(batch_id)) else spark.createDataFrame([], schema)

    def split(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The events to apply now: those that waited and those of the batch, without those that wait from now on."""
        key = self.table.key
        before = self.held(batch_id - 1, batch)
        gone_on = batch.select(F.col("_shard").alias("_on")).distinct()
        waited = before.join(gone_on, F.col("_shard").eqNullSafe(F.col("_on")), "left").withColumn("_waited", F.col("_waited") + F.col("_on").isNotNull().cast("int")).drop("_on")
        events = batch.withColumn("_waited", F.lit(0)).unionByName(waited)
        last = events.where(F.col("_event_type").isin(cl.INSERT, cl.AFTER_UPDATE, cl.DELETE, cl.BEFORE_UPDATE)).groupBy(*key).agg(
            F.max_by(F.struct(*events.columns), "_lsn").alias("_last")).select("_last.*")
        last.where((F.col("_event_type") == cl.BEFORE_UPDATE) & (F.col("_waited") < self.patience)).write.mode("overwrite").parquet(self._of(batch_id))
        store.remove(batch.sparkSession, self._of(batch_id - 2))
        waiting = self.held(batch_id, batch).select(*[F.col(k).alias(f"_h_{k}") for k in key], F.col("_lsn").alias("_h_lsn"))
        match = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in key] + [F.col("_lsn") == F.col("_h_lsn")]
        return events.drop("_waited").join(waiting, match, "left_anti")

    def release(self, like: DataFrame) -> None:
        """Apply the deletes that still wait, as after the end of a stream."""
        spark = like.sparkSession
        last = max((int(n) for n in store.names(spark, self.folder)), default=None)
        if last is not None:
            self.table.merge(as_mutations(self.held(last, like).drop("_waited"), False))
            store.remove(spark, self._of(last))


def _writer(batch: DataFrame, checkpoint: str, batch_id: int) -> tuple[str, int]:
    """The stream, by the id that its checkpoint keeps, and its batch."""
    told = store.read_text(batch.sparkSession, f"{checkpoint}/metadata")
    return json.loads(told)["id"] if told else checkpoint, batch_id


def upsert(
    stream: DataFrame, table: KeyedTable, checkpoint: str, ignore_delete: bool = True, available_now: bool = True, hold: bool = True, patience: int = 1, **how,
) -> StreamingQuery:
    """Merge a change stream into a table, one micro-batch at a time; with ``hold`` deletes wait for their updates."""
    return _started(stream.writeStream.foreachBatch(merging(table, checkpoint, ignore_delete, hold, patience, **how)), checkpoint, available_now)


def merging(table: KeyedTable, checkpoint: str, ignore_delete: bool = True, hold: bool = True, patience: int = 1, **how) -> Callable[[DataFrame, int], None]:
    """What ``upsert`` does with a micro-batch of events; also a step for ``changelog_source.follow``, where with
    ``evolve`` the columns that the log gains become the table's."""
    held = HeldDeletes(table, f"{checkpoint}/held", patience)

    def merge(batch: DataFrame, batch_id: int) -> None:
        events = held.split(batch, batch_id) if hold and not ignore_delete else batch
        changes = as_mutations(events, ignore_delete).persist()  # a merge reads them for their buckets, deletes and puts
        try:
            table.merge(changes, once=_writer(batch, checkpoint, batch_id), **how)
        finally:
            changes.unpersist()

    return merge


def _started(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def upsert_rows(stream: DataFrame, table: KeyedTable, checkpoint: str, order: str, available_now: bool = True, mode: str = "update", **how) -> StreamingQuery:
    """Merge plain rows, as those of an aggregation in update mode; the greatest ``order`` of a key wins."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch.withColumn("_seq", F.col(order)), once=_writer(batch, checkpoint, batch_id), **how)

    return _started(stream.writeStream.outputMode(mode).foreachBatch(merge), checkpoint, available_now)


def route(batch: DataFrame, targets: dict[str, KeyedTable], column: str = "tablename", extra_columns: str = "error", unknown: str = "error") -> dict[str, DataFrame]:
    """Rows for each target by the name in a column.

    ``extra_columns``: what to do with columns that a target lacks and that hold values, ``error`` or
    ``drop``; ``unknown``: the same for names without a target. Both are found in one pass over the rows.
    """
    columns = {name: table.schema().names for name, table in targets.items()}
    extra = {name: [c for c in batch.columns if c not in {*known, column, "_seq", "_op", "_set"}] for name, known in columns.items()}
    tests = {}
    if unknown == "error":
        tests[None] = ~F.coalesce(F.col(column).isin(list(targets)), F.lit(False))
    if extra_columns == "error":
        tests |= {name: (F.col(column) == name) & F.greatest(*[F.col(c).isNotNull() for c in more], F.lit(False)) for name, more in extra.items() if more}
    if tests:
        found = batch.agg(*[F.count_if(t).alias(f"n{i}") for i, t in enumerate(tests.values())], *([F.max(F.when(tests[None], F.col(column))).alias("lost")] if None in tests else [])).first()
        for i, name in enumerate(tests):
            if found[f"n{i}"]:
                raise ValueError(f"no table {found['lost']}" if name is None else f"table {name} lacks one of {extra[name]}")
    return {name: batch.where(F.col(column) == name).select([c for c in batch.columns if c in known or c in ("_seq", "_op", "_set")]) for name, known in columns.items()}


def route_stream(stream: DataFrame, targets: dict[str, KeyedTable], checkpoint: str, sequence: Callable[[DataFrame], DataFrame], available_now: bool = True, **how) -> StreamingQuery:
    """Route every micro-batch, which is read once; ``sequence`` adds ``_seq``."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = sequence(batch).persist()
        try:
            for name, own in route(rows, targets, **how).items():
                targets[name].merge(own, once=_writer(batch, checkpoint, batch_id))
        finally:
            rows.unpersist()

    return _started(stream.writeStream.foreachBatch(merge), checkpoint, available_now)
