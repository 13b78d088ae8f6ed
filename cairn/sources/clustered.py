"""A table laid out by its clustering key: sorted ranges that tell their bounds.

Rows are dealt to tasks of about ``TASK_ROWS`` by ranges of the key and sorted within; a task cuts
its rows into the table's ranges, so there are no more tasks for small ranges than for large ones.
Each range is written to a folder of its own; beside them lie the bounds of every key column and
the number of rows of each range.
A scan reads the ranges that its conditions may meet, and within them Parquet's statistics
skip row groups. The first rows in key order come from the first ranges: of conditions on the
key alone no more ranges are read than hold them.

Order is ascending with nulls last, as in ``scan.scan``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn import store
from cairn.operators import scan

#: Rows of a range, and bytes of a row group within it.
RANGE_ROWS, GROUP_BYTES = 1_000_000, 8 << 20
#: Rows and ranges, files each, that a task writes: about so many at most.
TASK_ROWS, TASK_RANGES = 1_000_000, 128
#: Numbers of ranges that are set aside for a task, which may get more rows than others.
_STRIDE = 1 << 32


class ClusteredTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    @classmethod
    def write(cls, rows: DataFrame, path: str, key: Sequence[str], range_rows: int = RANGE_ROWS) -> ClusteredTable:
        """Write the rows, clustered by ``key`` (suffixes ``:asc`` and ``:desc`` are ignored)."""
        spark = rows.sparkSession
        names = [k.rsplit(":", 1)[0] if k.endswith((":asc", ":desc")) and k not in rows.columns else k for k in key]
        order = [F.col(f"`{n}`").asc_nulls_last() for n in names]
        n = rows.count()
        held = min(max(1, -(-n // range_rows)), max(1, TASK_ROWS // range_rows), TASK_RANGES)  # ranges of a task
        tasks = max(1, -(-n // (held * range_rows)))
        parts = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        numbered = parts.withColumn("_row", F.monotonically_increasing_id())  # the task and the row's place in it
        place = F.col("_row").bitwiseAND((1 << 33) - 1)
        dealt = numbered.withColumn("_range", F.shiftright("_row", 33) * _STRIDE + F.floor(place / range_rows)).drop("_row").sortWithinPartitions("_range", *order)
        dealt.write.option("parquet.block.size", GROUP_BYTES).partitionBy("_range").parquet(f"{path}/rows")
        stored = spark.read.schema(dealt.schema).parquet(f"{path}/rows")
        bounds = [f(f"`{n}`").alias(f"{w}_{i}") for i, n in enumerate(names) for w, f in (("least", F.min), ("most", F.max))]
        nulls = [F.count_if(F.col(f"`{n}`").isNull()).alias(f"nulls_{i}") for i, n in enumerate(names)]
        stored.groupBy("_range").agg(F.count("*").alias("n"), *bounds, *nulls).coalesce(1).write.parquet(f"{path}/ranges")  # a row a range
        store.write_text(spark, f"{path}/key.json", "\n".join([rows.schema.json(), *names]))
        return cls(spark, path)

    def _told(self) -> tuple[Any, list[str]]:
        from json import loads

        from pyspark.sql import types as T

        schema, *names = (store.read_text(self.spark, f"{self.path}/key.json") or "").split("\n")
        return T.StructType.fromJson(loads(schema)), names

    def ranges(self, equal: dict[str, Any] | None = None, between: dict[str, tuple[Any, Any]] | None = None) -> list[tuple[int, int]]:
        """(range, rows) of those that may hold rows for the conditions, in key order."""
        _, names = self._told()
        kept = self.spark.read.parquet(f"{self.path}/ranges")
        meets: list[Column] = []
        for i, name in enumerate(names):
            least, most = F.col(f"least_{i}"), F.col(f"most_{i}")
            if name in (equal or {}):
                meets += [least <= F.lit(equal[name]), most >= F.lit(equal[name])]
            if name in (between or {}):
                start, stop = between[name]
                meets += [most >= F.lit(start)] * (start is not None) + [least < F.lit(stop)] * (stop is not None)
        if meets:
            kept = kept.where(reduce(lambda a, b: a & b, meets))
        return [tuple(r) for r in kept.select("_range", "n").orderBy("_range").collect()]

    def _rows(self, ranges: Sequence[int]) -> DataFrame:
        schema, _ = self._told()
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/rows/_range={r}" for r in ranges]) if ranges else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._rows([r for r, _ in self.ranges()])

    def scan(self, equal: dict[str, Any] | None = None, between: dict[str, tuple[Any, Any]] | None = None, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
        """Rows that meet the conditions, in key order; with ``limit`` the first of them."""
        _, names = self._told()
        met = self.ranges(equal, between)
        if limit is not None:
            met = self._enough(met, equal, between, limit)
        return scan.scan(self._rows([r for r, _ in met]), equal, between, columns, names, limit)

    def _enough(self, met: list[tuple[int, int]], equal: dict[str, Any] | None, between: dict[str, tuple[Any, Any]] | None, limit: int) -> list[tuple[int, int]]:
        """The first ranges that hold ``limit`` rows: by their numbers of rows where there is no condition, else by counting in ever more of them."""
        wanted = scan.condition(equal, between)
        at, seen = 0, 0
        step = 1
        while at < len(met) and seen < limit:
            more = met[at : at + step]
            seen += sum(n for _, n in more) if wanted is None else self._rows([r for r, _ in more]).where(wanted).limit(limit).count()
            at, step = at + len(more), step if wanted is None else 2 * step
        return met[:at]
