"""Exact distinct counts in event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def allowed_lateness(seconds: int) -> int:
    return max(1, seconds // 2)


def window_bitmaps(events: DataFrame, ts: str, ids: str, by: Sequence[str], seconds: int) -> DataFrame:
    """Group columns, window end, bucket and bitmap of ids; on a stream with the watermark of the allowed lateness."""
    if events.isStreaming:
        events = events.withWatermark(ts, f"{allowed_lateness(seconds)} seconds")
    window = F.window(ts, f"{seconds} seconds")
    made = events.where(F.col(ids).isNotNull()).groupBy(*by, window.alias("_w"), F.bitmap_bucket_number(ids).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bitmap"))
    return made.select(*by, F.col("_w.end").alias("window_end"), "bucket", "bitmap")


def window_uv(events: DataFrame, ts: str, ids: str, by: Sequence[str], seconds: int) -> DataFrame:
    """Distinct ids of each group and tumbling window, in batch."""
    return window_bitmaps(events, ts, ids, by, seconds).groupBy(*by, "window_end").agg(F.sum(F.bitmap_count("bitmap")).alias("uv"))
