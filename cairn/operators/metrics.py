"""Counts, rates and latencies of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cairn.operators import ranges

FIELDS = ("count", "mean", "p99", "p999")


def latency(df: DataFrame, value: str, by: Sequence[str] = (), exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """count, mean, p99 and p999 of a column; percentiles from mergeable sketches unless ``exact``."""
    plain = [F.count(value).alias("count"), F.avg(value).alias("mean")]
    at = {"p99": 0.99, "p999": 0.999}
    if not exact:
        return df.groupBy(*by).agg(*plain, *[F.percentile_approx(value, F.lit(p), F.lit(accuracy)).alias(k) for k, p in at.items()])
    found = ranges.percentiles(df, value, at, by).select(*[F.col(b).alias(f"__p_{b}") for b in by], *at)
    match = [F.col(b).eqNullSafe(F.col(f"__p_{b}")) for b in by] or F.lit(True)  # one row where there are no groups
    return df.groupBy(*by).agg(*plain).join(found, match, "left").select(*by, *FIELDS)


def rate(df: DataFrame, ts: str, minutes: Sequence[int] = (1, 5, 15), now: Column | None = None) -> DataFrame:
    """Rows a second over the last 1, 5 and 15 minutes before ``now`` (default: the latest row)."""
    stamped = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
    last = stamped.agg(F.max("t").alias("end")) if now is None else df.sparkSession.range(1).select(F.unix_micros(now).alias("end"))
    within = stamped.join(F.broadcast(last), F.lit(True))  # one row
    return within.agg(*[(F.count_if(F.col("t") > F.col("end") - m * 60_000_000) / (m * 60)).alias(f"qps{m}") for m in minutes])


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame, and an observation of its row count that is filled when an action runs."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("count")), watch
