"""Change logs: made from snapshots, filtered, projected and replayed.

A log has ``_shard``, ``_lsn`` (order within a shard), ``_event_type``, ``_ts_us``
and the table's columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import ranges

#: Event type codes.
DELETE, BEFORE_UPDATE, INSERT, AFTER_UPDATE, HEARTBEAT = 2, 3, 5, 7, 27
NAMES = {DELETE: "DELETE", BEFORE_UPDATE: "BEFORE_UPDATE", INSERT: "INSERT", AFTER_UPDATE: "AFTER_UPDATE", -1: "HEARTBEAT", HEARTBEAT: "HEARTBEAT"}
SYSTEM = ("_shard", "_lsn", "_event_type", "_ts_us")
OPERATORS = {
    "GREATER": lambda c, v: c > v, "GREATER_EQUAL": lambda c, v: c >= v, "LESS": lambda c, v: c < v, "LESS_EQUAL": lambda c, v: c <= v,
    "EQUAL": lambda c, v: c == v, "NOT_EQUAL": lambda c, v: c != v, "IS_NULL": lambda c, v: c.isNull(), "IS_NOT_NULL": lambda c, v: c.isNotNull(),
}


def diff(old: DataFrame, new: DataFrame, key: Sequence[str], shard: Column, ts_us: Column) -> DataFrame:
    """The changes that lead from one snapshot to another.

    Within a shard, changes are ordered by key and an update's before comes before its after.
    """
    values = [c for c in old.columns if c not in key]
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns], F.lit(True).alias("o_"))
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in old.columns], F.lit(True).alias("n_"))
    both = o.join(n, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in key], "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"o_{v}").eqNullSafe(F.col(f"n_{v}")) for v in values], F.lit(False))
    side = lambda p, kind: F.struct(F.lit(kind).alias("_event_type"), *[F.col(f"{p}_{c}").alias(c) for c in old.columns])
    events = (
        F.when(F.col("o_").isNull(), F.array(side("n", INSERT))).when(F.col("n_").isNull(), F.array(side("o", DELETE)))
        .when(differs, F.array(side("o", BEFORE_UPDATE), side("n", AFTER_UPDATE))).otherwise(F.array()))
    rows = both.select(F.explode(events).alias("e")).select("e.*").withColumn("_shard", shard).withColumn("_ts_us", ts_us)
    return ranges.numbered(rows, "_lsn", ["_shard"], [*key, "_event_type"]).select(*SYSTEM, *old.columns)


def replay(base: DataFrame, log: DataFrame, key: Sequence[str]) -> DataFrame:
    """The table after the log: per key the last event decides."""
    log = log.where(F.col("_event_type").isin(DELETE, INSERT, AFTER_UPDATE))
    last = log.groupBy(*key).agg(F.max_by(F.struct("_event_type", *base.columns), "_lsn").alias("_e"))
    kept = base.join(last.select(*key), [base[k].eqNullSafe(last[k]) for k in key], "left_anti")
    return kept.unionByName(last.where(F.col("_e._event_type") != DELETE).select(*[F.col("_e")[c].alias(c) for c in base.columns]))


def select(
    log: DataFrame, columns: Sequence[str] | None = None, filters: Sequence[tuple[str, str, object]] = (), start_us: int | None = None,
    offsets: dict[int, int] | None = None, ignore_delete: bool = False, ignore_before_update: bool = False,
) -> DataFrame:
    """Part of a log: from a time or from the record after each shard's offset, filtered by (column, operator, value), projected.

    Filters are a conjunction and may use columns outside the projection. Where a start
    time and offsets are given the offsets hold.
    """
    out = log
    if offsets:
        seen = reduce(lambda a, s: a.when(F.col("_shard") == s[0], F.lit(s[1])), offsets.items(), F.when(F.lit(False), F.lit(0)))
        out = out.where(F.col("_shard").isin(list(offsets)) & (F.col("_lsn") > seen))
    elif start_us is not None:
        out = out.where(F.col("_ts_us") >= start_us)
    dropped = [DELETE] * ignore_delete + [BEFORE_UPDATE] * ignore_before_update
    if dropped:
        out = out.where(~F.col("_event_type").isin(dropped))
    for column, operator, value in filters:
        if operator not in OPERATORS:
            raise ValueError(f"no such operator: {operator}")
        out = out.where(OPERATORS[operator](F.col(column), F.lit(value)))
    if columns is not None:
        if missing := [c for c in columns if c not in log.columns]:
            raise ValueError(f"no such columns: {missing}")
        out = out.select(*SYSTEM, *[c for c in log.columns if c in set(columns) - set(SYSTEM)])
    return out


def latest(log: DataFrame) -> DataFrame:
    """Last position of each shard."""
    return log.groupBy("_shard").agg(F.max("_lsn").alias("_lsn"))


def in_partitions(log: DataFrame, columns: Sequence[str], values: Sequence[Sequence[object]]) -> DataFrame:
    """Restrict a log to given tuples of partition columns."""
    if any(len(v) != len(columns) for v in values):
        raise ValueError("every tuple needs a value for each partition column")
    tuples = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c) == F.lit(x) for c, x in zip(columns, v, strict=True)]) for v in values], F.lit(False))
    return log.where(tuples)


def open_partitions(log: DataFrame, partition_start: Column, partition_end: Column, lateness_seconds: int = 60, carried: DataFrame | None = None) -> DataFrame:
    """Dynamic subscription: drop records that arrive after their partition has been closed for their shard.

    A shard closes a partition once its event time (the greatest time seen so far in it)
    has passed the end by the lateness. ``carried`` has the time (``_carried``) that each ``_shard`` comes with, a row each.
    """
    seen = ranges.running_max(log, "__seen", F.col("_ts_us"), ["_shard"], ["_lsn"])
    if carried is not None:
        seen = seen.join(carried, "_shard", "left").withColumn("__seen", F.greatest("__seen", "_carried")).select(*log.columns, "__seen")
    late = F.col("__seen") >= F.unix_micros(partition_end.cast("timestamp")) + lateness_seconds * 1_000_000
    early = F.col("_ts_us") < F.unix_micros(partition_start.cast("timestamp"))
    return seen.withColumn("__late", late | early).where("NOT __late").drop("__late", "__seen")


def closed_partitions(log: DataFrame, partition_end: Column, lateness_seconds: int = 60) -> DataFrame:
    """(partition_end): the partitions that every shard of the log has closed, so that their subscription may end."""
    shards = log.groupBy("_shard").agg(F.max("_ts_us").alias("seen"))
    reached = shards.agg(F.min("seen").alias("reached"))  # one row
    ends = log.select(partition_end.cast("timestamp").alias("partition_end")).distinct()
    return ends.join(reached, F.col("reached") >= F.unix_micros("partition_end") + lateness_seconds * 1_000_000).select("partition_end")
