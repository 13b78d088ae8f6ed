"""Ranks and running values over ordered rows without sorting all rows of a group in one task.

Rows are laid out once in range partitions of (group, order) and stored in the shared
folder with the number of their partition, so that every later step sees the same
partitions. Each partition works out its own part; one row for each partition and
group carries what comes before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import work_dir

_PART, _LOCAL, _OWN, _BEFORE = "__part", "__local", "__own", "__before"


def laid_out(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows, stored, with ``__part``: the range partition of (by, order) that holds each."""
    folder = work_dir(rows.sparkSession, "ranges")
    rows.repartitionByRange(*by, *order).withColumn(_PART, F.spark_partition_id()).write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _running(rows: DataFrame, name: str, value: Column, fold, by: Sequence[str], order: Sequence[str], join) -> DataFrame:
    parted = laid_out(rows, by, order)
    to_here = Window.partitionBy(_PART, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parted.groupBy(_PART, *by).agg(fold(value).alias(_OWN)).select(
        F.col(_PART).alias(f"{_PART}_"), *[F.col(b).alias(f"__by_{i}") for i, b in enumerate(by)], fold(_OWN).over(earlier).alias(_BEFORE))
    match = [F.col(_PART) == F.col(f"{_PART}_"), *[F.col(b).eqNullSafe(F.col(f"__by_{i}")) for i, b in enumerate(by)]]
    found = parted.withColumn(_LOCAL, fold(value).over(to_here)).join(parts, match)
    return found.select(*rows.columns, join(F.col(_BEFORE), F.col(_LOCAL)).alias(name))


def running_sum(rows: DataFrame, name: str, value: Column, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with the sum of ``value`` over the group's rows up to each, in a total order."""
    return _running(rows, name, value, F.sum, by, order, lambda before, own: F.coalesce(before, F.lit(0)) + own)


def running_max(rows: DataFrame, name: str, value: Column, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with the greatest ``value`` of the group's rows up to each, in a total order."""
    return _running(rows, name, value, F.max, by, order, lambda before, own: F.greatest(before, own))


def numbered(rows: DataFrame, name: str, by: Sequence[str], order: Sequence[str], start: int | Column = 0) -> DataFrame:
    """The rows numbered ``start`` + 1, + 2, ... within each group, in a total order."""
    first = start if isinstance(start, Column) else F.lit(start)
    return running_sum(rows, name, F.lit(1), by, order).withColumn(name, (F.col(name) + first).cast("long"))


def percentiles(rows: DataFrame, value: str, at: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated percentiles of each group: equal values are counted first, and the counts summed up in ranges."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    upto = running_sum(counted, "__upto", F.col("__n"), by, [value])
    total = counted.groupBy(*by).agg(F.sum("__n").alias("__all"))
    match = [F.col(b).eqNullSafe(F.col(f"__t_{b}")) for b in by] or F.lit(True)  # one row where there are no groups
    joined = upto.join(total.select(*[F.col(b).alias(f"__t_{b}") for b in by], "__all"), match)
    place = {k: (F.col("__all") - 1) * F.lit(p) for k, p in at.items()}
    reach = lambda x: F.min(F.when(F.col("__upto") > x, F.col(value)))
    found = joined.groupBy(*by).agg(
        *[reach(F.floor(x)).alias(f"__low_{k}") for k, x in place.items()], *[reach(F.ceil(x)).alias(f"__high_{k}") for k, x in place.items()],
        *[F.any_value(x - F.floor(x)).alias(f"__rest_{k}") for k, x in place.items()])
    return found.select(*by, *[(F.col(f"__low_{k}") + (F.col(f"__high_{k}") - F.col(f"__low_{k}")) * F.col(f"__rest_{k}")).alias(k) for k in at])
