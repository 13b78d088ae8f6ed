"""Distinct counts of event-time windows that are given before a window ends, again and again.

The time of the stream is the greatest event time of the micro-batches before. A window gives
its count whenever that time passes a multiple of the interval after its first record, once it
passes its end, and at once for records that come later, up to the allowed lateness after the
end; then it is forgotten. The watermark of the stream is behind its time by the lateness, so
records within it are not dropped. A window of a group is kept in buckets of ids, each of
at most 4096 bytes of state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cairn.streaming.windows import allowed_lateness

_BUCKET_BITS = 15


def interval(seconds: int) -> int:
    """Seconds of event time between two counts of a window of ``seconds``."""
    return max(1, seconds // 20)


def due(time_ms: int, first_ms: int, last_ms: int, end_ms: int, step_ms: int, late: bool) -> int | None:
    """When a window gives a count, or None: the end, a multiple of the interval not yet given, or now for late records.

    ``first_ms``: its first record; ``last_ms``: when it gave one last, 0 if never; ``late``: there are new records.
    """
    if time_ms >= end_ms:
        return end_ms if last_ms < end_ms else time_ms if late else None
    passed = time_ms // step_ms * step_ms
    return passed if passed > max(first_ms, last_ms) else None


def early_counts(events: DataFrame, ts: str, ids: str, by: Sequence[str], seconds: int) -> DataFrame:
    """(group columns, window_end, bucket, uv, given_at): the counts as they are given, to be written in update mode.

    A later row of a (group, window, bucket) replaces an earlier one; a window's count is the sum over its buckets.
    """
    late_ms, step_ms = 1000 * allowed_lateness(seconds), 1000 * interval(seconds)
    marked = events.withWatermark(ts, f"{allowed_lateness(seconds)} seconds").where(F.col(ids).isNotNull())
    rows = marked.select(
        *by, F.unix_millis(F.window(ts, f"{seconds} seconds").end).alias("end_ms"), F.shiftright(F.col(ids).cast("long"), _BUCKET_BITS).alias("bucket"),
        F.pmod(F.col(ids).cast("long"), F.lit(1 << _BUCKET_BITS)).cast("int").alias("place"), F.unix_millis(ts).alias("at_ms"), ts)
    kinds = dict(rows.dtypes)
    keys = [*by, "end_ms", "bucket"]
    out = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", uv long, given_ms long"

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        end_ms = int(key[len(by)])
        mark = state.getCurrentWatermarkMs()
        time_ms = mark + late_ms if mark > 0 else 0
        packed, first, last = state.get if state.exists else (b"", end_ms, 0)
        bits = np.zeros(1 << _BUCKET_BITS >> 3, np.uint8) if not packed else np.frombuffer(packed, np.uint8).copy()
        new = False
        for part in parts:
            part = part[part["at_ms"] >= mark] if len(part) else part  # what is behind the watermark is too late
            if part.empty:  # a timer alone, or nothing but late records
                continue
            places = part["place"].to_numpy()
            np.bitwise_or.at(bits, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
            first, new = min(first, int(part["at_ms"].min())), True
        given = due(time_ms, first, last, end_ms, step_ms, new)
        if given is not None:
            last = given
            yield pd.DataFrame([[*key, int(np.unpackbits(bits).sum()), given]], columns=[*keys, "uv", "given_ms"])
        if mark >= end_ms:
            state.remove()
            return
        state.update((bits.tobytes(), first, last))
        following = (max(time_ms, first) // step_ms + 1) * step_ms
        wake = min(following, end_ms) if time_ms < end_ms else end_ms + late_ms
        state.setTimeoutTimestamp(max(wake - late_ms - 1, mark))  # a timer goes off once the watermark is beyond it

    made = rows.groupBy(*keys).applyInPandasWithState(step, out, "bits binary, first long, last long", "update", GroupStateTimeout.EventTimeTimeout)
    return made.select(*by, F.timestamp_millis("end_ms").alias("window_end"), "bucket", "uv", F.timestamp_millis("given_ms").alias("given_at"))
