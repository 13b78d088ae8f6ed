"""One object for the whole surface: tables by name below a shared folder."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from cairn.operators import changelog, scan
from cairn.schema import TableDef
from cairn.sources import changelog_source, csvio
from cairn.sources.keyed_table import KeyedTable
from cairn.streaming import sinks
from cairn.streaming.partitions import PartitionSubscription


class Engine:
    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None) -> None:
        self.spark, self.folder, self.buckets = spark, folder, buckets

    def _keyed(self, name: str, key: Sequence[str], buckets: int | None = None) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.folder}/{name}", key, buckets)

    def create(self, table: TableDef, rows: DataFrame | None = None) -> None:
        if not table.primary_key:
            raise ValueError("a keyed table needs a primary key")
        self._keyed(table.name, table.primary_key, self.buckets).create(self.spark.createDataFrame([], table.schema()) if rows is None else rows.select(*[c.name for c in table.columns]), table)

    def table(self, name: str) -> TableDef:
        return self._keyed(name, []).definition()

    def keyed(self, name: str) -> KeyedTable:
        return self._keyed(name, self.table(name).primary_key)

    def read(self, name: str) -> DataFrame:
        table = self.table(name)
        return self._keyed(name, table.primary_key).read().select(*[c.name for c in table.columns])

    def register(self, *names: str) -> None:
        """Make tables visible to ``sql``."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text)

    def get(self, name: str, keys: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        return self.keyed(name).get(keys, columns)

    def scan(self, name: str, equal: dict[str, Any] | None = None, between: dict[str, tuple] | None = None, columns: Sequence[str] | None = None, sort: str | None = "pk", limit: int | None = None) -> DataFrame:
        """``sort``: 'pk', 'clustering' or None."""
        table = self.table(name)
        order = {"pk": table.primary_key, "clustering": table.clustering_key, None: None}[sort]
        return scan.scan(self.read(name), equal, between, columns, order, limit)

    def put(self, name: str, changes: DataFrame, **how) -> None:
        self.keyed(name).merge(changes, **how)

    def check_and_put(self, name: str, changes: DataFrame, column: str, operator: str, value: str | None = None, null_as: str | None = None) -> None:
        self.keyed(name).check_and_put(changes, column, operator, value, null_as)

    def expression_upsert(self, name: str, changes: DataFrame, set_: dict[str, str] | None = None, where: str | None = None) -> None:
        self.keyed(name).expression_upsert(changes, set_, where)

    def append_changes(self, path: str, log: DataFrame) -> None:
        """Append to a stored change log."""
        changelog_source.write_changelog(log, path)

    def export_csv(self, name: str, path: str, **how) -> None:
        csvio.export_csv(self.read(name), path, **how)

    def import_csv(self, name: str, path: str, mode: str = "replace", **how) -> None:
        from pyspark.sql import functions as F

        rows = csvio.import_csv(self.spark, path, self.table(name).schema(), **how)
        self.put(name, rows.withColumn("_seq", F.monotonically_increasing_id()), mode=mode)

    def changes(self, path: str, offsets: dict[int, int] | None = None, streaming: bool = False, **how) -> DataFrame:
        return changelog.select(changelog_source.subscribe(self.spark, path, offsets, streaming), **how)

    def follow(self, name: str, stream: DataFrame, checkpoint: str, **how):
        """Merge a change stream into a table."""
        return sinks.upsert(stream, self.keyed(name), checkpoint, **how)

    def follow_log(self, name: str, path: str, checkpoint: str, offsets: dict[int, int] | None = None, available_now: bool = True, **how):
        """Merge a stored change log into a table; columns that the log gains, or that become wider there, become the table's."""
        step = sinks.merging(self.keyed(name), checkpoint, evolve=True, **how)
        return changelog_source.follow(self.spark, path, step, checkpoint, offsets, available_now)

    def partitions(self, name: str, unit: str, shards: Sequence[int], lateness_seconds: int = 60) -> PartitionSubscription:
        """Follow the time partitions of a table's change stream; see ``PartitionSubscription.start``."""
        return PartitionSubscription(self.spark, f"{self.folder}/{name}.partitions", unit, shards, lateness_seconds)
