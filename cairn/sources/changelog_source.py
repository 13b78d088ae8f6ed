"""A change log on shared storage: appended in commits, read by Spark's own Parquet scan, in batch and as a stream.

Layout: ``<path>/data/<name>/*.parquet``, the rows of one append, in the order of shard and
position, and ``<path>/commits/<n>.json`` with the first and last position of each shard in it
and the log's columns from then on. An append writes beside the log, moves its folder into
place at once and tells its ranges last, so readers see an append whole or not at all; no
reader opens a footer to find out where a shard ends. Rows are dealt by ranges of (shard,
position): a hot shard lies in many files, and every file can be split.

Columns can be added by any append, or made wider: each commit holds the columns as they are
then, and older rows are read with nulls there, or widened. ``follow`` takes the newest
columns with every micro-batch; a stream from ``subscribe`` keeps those it started with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cairn import store
from cairn.schema import WIDENING

ATTEMPTS = 20
_COMMIT = "number long, name string, schema string, shards map<string, array<long>>, ends map<string, long>"


@dataclass
class Commit:
    """``shards``: first and last position and number of rows of each shard here; ``ends``: the log's last positions from then on."""

    number: int
    name: str
    schema: str
    shards: dict[str, list[int]]
    ends: dict[str, int]


def commits(spark: SparkSession, path: str, after: int = -1) -> list[Commit]:
    """The appends after one, in order."""
    numbers = sorted(int(n.removesuffix(".json")) for n in store.names(spark, f"{path}/commits") if n.endswith(".json"))
    return [Commit(**json.loads(store.read_text(spark, f"{path}/commits/{n:010d}.json"))) for n in numbers if n > after]


def _newest(spark: SparkSession, path: str) -> Commit | None:
    numbers = [n for n in store.names(spark, f"{path}/commits") if n.endswith(".json")]
    return Commit(**json.loads(store.read_text(spark, f"{path}/commits/{max(numbers)}"))) if numbers else None


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both, the wider of two types where one may become the other; other differences are an error."""
    out, known = [], {f.name: f.dataType for f in new}
    for f in old:
        other = known.pop(f.name, f.dataType)
        pair = f.dataType.simpleString(), other.simpleString()
        if pair[0] != pair[1] and pair not in WIDENING and pair[::-1] not in WIDENING:
            raise ValueError(f"column {f.name} is {pair[0]} in the log, not {pair[1]}")
        out.append(T.StructField(f.name, other if pair in WIDENING else f.dataType))
    return T.StructType([*out, *(T.StructField(n, t) for n, t in known.items())])


def write_changelog(log: DataFrame, path: str, mode: str = "append") -> None:
    """Append a log of changes; ``overwrite`` starts the log anew."""
    spark = log.sparkSession
    if mode == "overwrite":
        store.remove(spark, path)
    name = uuid.uuid4().hex
    staged = f"{path}/staged/{name}"
    log.repartitionByRange("_shard", "_lsn").sortWithinPartitions("_shard", "_lsn").write.parquet(staged)
    told = spark.read.schema(log.schema).parquet(staged).groupBy("_shard").agg(F.min("_lsn"), F.max("_lsn"), F.count("*")).collect()  # a row a shard
    store.move(spark, staged, f"{path}/data/{name}")
    own = T.StructType([T.StructField(f.name, f.dataType) for f in log.schema])
    for _ in range(ATTEMPTS):
        last = _newest(spark, path)
        schema = merged(T.StructType.fromJson(json.loads(last.schema)), own) if last else own
        shards = {str(r[0]): list(r[1:]) for r in told}
        before = last.ends if last else {}
        ends = before | {s: max(before.get(s, end), end) for s, (_, end, _) in shards.items()}
        made = Commit(last.number + 1 if last else 0, name, schema.json(), shards, ends)
        if store.create(spark, f"{path}/commits/{made.number:010d}.json", json.dumps(asdict(made))):
            return
    raise RuntimeError(f"other writers keep appending to the log at {path}")


def latest(spark: SparkSession, path: str) -> dict[int, int]:
    """Last position of each shard, from the newest commit alone."""
    last = _newest(spark, path)
    return {int(s): end for s, end in last.ends.items()} if last else {}


def _after(offsets: dict[int, int] | None) -> Column:
    if not offsets:
        return F.lit(True)
    seen = reduce(lambda a, s: a.when(F.col("_shard") == s[0], F.lit(s[1])), offsets.items(), F.when(F.lit(False), F.lit(0).cast("long")))
    least = min(offsets.values())
    # the plain part reaches the scan
    return (~F.col("_shard").isin(list(offsets)) | (F.col("_lsn") > least)) & (seen.isNull() | (F.col("_lsn") > seen))


def _read(spark: SparkSession, path: str, found: list[Commit], schema: T.StructType, offsets: dict[int, int] | None) -> DataFrame:
    """The rows of some commits beyond the offsets; commits that have none are not read."""
    beyond = [c for c in found if any(last > (offsets or {}).get(int(s), last - 1) for s, (_, last, _) in c.shards.items())]
    if not beyond:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{c.name}" for c in beyond]).where(_after(offsets))


def subscribe(spark: SparkSession, path: str, offsets: dict[int, int] | None = None, streaming: bool = True) -> DataFrame:
    """The log from the record after each shard's offset (default: from the oldest), with the columns that it has now."""
    last = _newest(spark, path)
    if last is None:
        raise ValueError(f"no change log at {path}")
    schema = T.StructType.fromJson(json.loads(last.schema))
    if streaming:
        return spark.readStream.schema(schema).parquet(f"{path}/data/*").where(_after(offsets))
    return _read(spark, path, commits(spark, path), schema, offsets)


def follow(
    spark: SparkSession, path: str, step: Callable[[DataFrame, int], None], checkpoint: str, offsets: dict[int, int] | None = None,
    available_now: bool = True, commits_per_batch: int = 100,
) -> StreamingQuery:
    """Hand the log to ``step``, some commits a micro-batch, each with the newest columns: what is streamed is the commits, and
    the rows they name are read by a batch scan."""

    def take(batch: DataFrame, batch_id: int) -> None:
        found = sorted((Commit(r["number"], r["name"], r["schema"], {s: list(v) for s, v in r["shards"].items()}, r["ends"]) for r in batch.collect()), key=lambda c: c.number)
        if found:
            step(_read(spark, path, found, T.StructType.fromJson(json.loads(found[-1].schema)), offsets), batch_id)

    stream = spark.readStream.schema(_COMMIT).option("maxFilesPerTrigger", commits_per_batch).option("pathGlobFilter", "*.json").json(f"{path}/commits")
    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
