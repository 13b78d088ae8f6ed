"""A change stream followed through the time partitions of its table, which open and close as its shards go on.

The time of a shard is the greatest event time seen in it; a heartbeat moves it on where
there are no records. A shard is done with a partition once its time has passed the end by
the lateness, and drops what still comes for it; a heartbeat counts from the end of its micro-batch. The table is done with a partition once the
slowest shard is: then it closes. A partition opens when the time of the fastest shard
reaches it, so that between the first and the last none is missing.

Each micro-batch starts from the state that the one before left, writes its rows to a
folder of its own and leaves its state last; one that comes again writes the same. What the
driver keeps is a time a shard and the partitions that are open.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairn import store
from cairn.functions import partitioning
from cairn.operators import changelog as cl

_STEPS = {"HOUR": "1 hour", "DAY": "1 day", "MONTH": "1 month", "QUARTER": "3 months", "YEAR": "1 year"}
_CHILDREN = "partition string, event string, end_us long, _batch long"


def heartbeats(log: DataFrame, ts_us: dict[int, int]) -> DataFrame:
    """Records that say that a shard has nothing more up to a time, in the columns of a log."""
    spark = log.sparkSession
    rows = spark.createDataFrame([(s, -1, cl.HEARTBEAT, t) for s, t in ts_us.items()], "_shard int, _lsn long, _event_type int, _ts_us long")
    return rows.select(*[F.col(f.name).cast(f.dataType) if f.name in cl.SYSTEM else F.lit(None).cast(f.dataType).alias(f.name) for f in log.schema])


class PartitionSubscription:
    def __init__(self, spark: SparkSession, path: str, unit: str, shards: Sequence[int], lateness_seconds: int = 60, dashed: bool = False) -> None:
        """``shards``: those of the table; one that has not been heard of yet keeps every partition open."""
        self.spark, self.path, self.unit, self.shards, self.lateness, self.dashed = spark, path, unit.upper(), list(shards), lateness_seconds * 1_000_000, dashed

    def _state(self, batch_id: int) -> dict:
        """The shards' times and the open partitions (suffix to end) after a micro-batch."""
        text = store.read_text(self.spark, f"{self.path}/state/{batch_id}.json") if batch_id >= 0 else None
        return json.loads(text) if text else {"seen": {}, "open": {}, "from_us": None, "next_us": None}

    def _suffix(self, ts):
        return partitioning.suffix(ts, self.unit, self.dashed)

    def _units(self, from_us: int, upto_us: int) -> list[tuple[str, int, int]]:
        """(suffix, start, end) of the partitions from one time up to another."""
        trunc = lambda us: F.date_trunc(self.unit, F.timestamp_micros(F.lit(us)))
        starts = self.spark.range(1).select(F.explode(F.sequence(trunc(from_us), trunc(upto_us), F.expr(f"interval {_STEPS[self.unit]}"))).alias("start"))
        end = F.unix_micros(F.col("start") + F.expr(f"interval {_STEPS[self.unit]}"))
        return [tuple(r) for r in starts.select(self._suffix(F.col("start")), F.unix_micros("start"), end).collect()]

    def step(self, batch: DataFrame, batch_id: int) -> None:
        """Take one micro-batch: records with ``_ts_us``, in the order of ``_lsn`` in each shard, and heartbeats."""
        state = self._state(batch_id - 1)
        seen = {int(s): t for s, t in state["seen"].items()}
        ts = F.timestamp_micros("_ts_us")
        rows = batch.withColumn("_partition", self._suffix(ts))
        carried = self.spark.createDataFrame(list(seen.items()), "_shard int, _carried long")
        beat = F.col("_event_type").isin(cl.HEARTBEAT, -1)
        records = rows.where(~beat)
        kept = cl.open_partitions(
            records, partitioning.start(F.col("_partition"), self.unit, self.dashed), partitioning.stop(F.col("_partition"), self.unit, self.dashed),
            self.lateness // 1_000_000, carried)
        folder = f"{self.path}/rows/_batch={batch_id}"
        kept.write.mode("overwrite").partitionBy("_partition").parquet(folder)

        times = batch.groupBy("_shard").agg(F.max("_ts_us").alias("t"), F.min(F.when(~beat, F.col("_ts_us"))).alias("least")).collect()  # a row a shard
        for r in times:
            seen[r["_shard"]] = max(seen.get(r["_shard"], r["t"]), r["t"])
        self._leave(batch_id, state, seen, min((r["least"] for r in times if r["least"] is not None), default=None))

    def _leave(self, batch_id: int, state: dict, seen: dict[int, int], least: int | None) -> None:
        opened: list[tuple[str, int]] = []
        held, first, following = dict(state["open"]), state["from_us"], state["next_us"]
        begin = following if following is not None else least
        low = min(seen[s] for s in self.shards) if all(s in seen for s in self.shards) else None
        if begin is not None and seen and max(seen.values()) >= begin:
            for suffix, start, end in self._units(begin, max(seen.values())):
                opened.append((suffix, end))
                first, following = start if first is None else first, end
        held |= dict(opened)
        closed = [(suffix, end) for suffix, end in sorted(held.items()) if low is not None and low >= end + self.lateness]
        for suffix, _ in closed:
            del held[suffix]
        events = [(s, "open", e, batch_id) for s, e in opened] + [(s, "close", e, batch_id) for s, e in closed]
        self.spark.createDataFrame(events, _CHILDREN).coalesce(1).write.mode("overwrite").json(f"{self.path}/children/{batch_id}")
        store.write_text(self.spark, f"{self.path}/state/{batch_id}.json", json.dumps({"seen": seen, "open": held, "from_us": first, "next_us": following}))
        store.remove(self.spark, f"{self.path}/state/{batch_id - 2}.json")

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.step).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def children(self) -> DataFrame:
        """What has opened and closed, and in which micro-batch: (partition, event, end_us, _batch)."""
        folders = store.names(self.spark, f"{self.path}/children")
        return self.spark.read.schema(_CHILDREN).json([f"{self.path}/children/{n}" for n in folders]) if folders else self.spark.createDataFrame([], _CHILDREN)

    def rows(self, like: DataFrame, closed_only: bool = False) -> DataFrame:
        """The records taken so far, with their partition; or those of partitions that are complete."""
        schema = like.select("*", F.lit("").alias("_partition"), F.lit(0).cast("long").alias("_batch")).schema
        folder = f"{self.path}/rows"
        found = self.spark.read.schema(schema).parquet(folder).drop("_batch") if store.names(self.spark, folder) else self.spark.createDataFrame([], schema).drop("_batch")
        if not closed_only:
            return found
        closed = self.children().where("event = 'close'").select(F.col("partition").alias("_closed")).distinct()
        return found.join(closed, F.col("_partition") == F.col("_closed"), "left_semi")
