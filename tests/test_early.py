import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cairn.streaming import early
from cairn.streaming.windows import allowed_lateness

SECONDS = 40
T0 = 1_700_000_000 // SECONDS * SECONDS


def interpreter(batches):
    """What is given in each micro-batch: {(group, window end): (count, given at)}, one record and one timer after the other."""
    late, step = allowed_lateness(SECONDS), early.interval(SECONDS)
    held, out, mark, most = {}, [], 0, 0
    todo = list(batches)
    while todo or out and mark < most - late:
        batch = todo.pop(0) if todo else []
        mark = max(mark, most - late)
        time = mark + late if mark > 0 else 0
        given, new = {}, set()
        for group, second, uid in batch:
            if second < mark:  # beyond the lateness
                continue
            end = second // SECONDS * SECONDS + SECONDS
            ids, first, last = held.get((group, end), (set(), end, 0))
            held[group, end] = (ids | {uid}, min(first, second), last)
            new.add((group, end))
        for (group, end), (ids, first, last) in list(held.items()):
            at = None
            if time >= end:
                at = end if last < end else time if (group, end) in new else None
            elif time // step * step > max(first, last):
                at = time // step * step
            if at is not None:
                given[group, end] = (len(ids), at)
                held[group, end] = (ids, first, at)
            if mark >= end:
                del held[group, end]
        out.append(given)
        most = max([most, *(s for _, s, _ in batch)])
    return [g for g in out if g]


def run(spark, path, batches):
    schema, rows = "g string, ts timestamp, uid int", []
    for n, batch in enumerate(batches):
        made = [(g, dt.datetime.fromtimestamp(s, dt.UTC), u) for g, s, u in batch] + [("z", None, None)]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        for f in os.listdir(f"{path}/in"):
            if f.endswith(".parquet") and f not in rows:
                rows.append(f)
                os.utime(f"{path}/in/{f}", (1_000_000 + n, 1_000_000 + n))
    out = []

    def take(batch, _):
        found = batch.groupBy("g", "window_end").agg(F.sum("uv").alias("uv"), F.max("given_at").alias("at")).collect()
        if found:
            out.append({(r["g"], int(r["window_end"].timestamp())): (r["uv"], int(r["at"].timestamp())) for r in found})

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    early.early_counts(stream, "ts", "uid", ["g"], SECONDS).writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start().awaitTermination()
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_are_given_as_one_after_the_other(spark, tmp_path, seed):
    rng = random.Random(seed)
    now, batches = T0, []
    for _ in range(7):
        now += rng.randint(1, 25)
        batches.append([(rng.choice("ab"), now - rng.choice([0, 0, 1, 2, 15, 30]), rng.randint(1, 6)) for _ in range(rng.randint(1, 6))])
    assert run(spark, str(tmp_path), batches) == interpreter(batches)


def test_early_late_and_too_late(spark, tmp_path):
    batches = [[("a", T0, 1)], [("a", T0 + 9, 2)], [("a", T0 + 10, 3)], [("a", T0 + 45, 9)], [("a", T0 + 30, 4)], [("a", T0 + 70, 9)], [("a", T0 + 39, 5)], [("a", T0 + 71, 9)]]
    got = run(spark, str(tmp_path), batches)
    assert got == interpreter(batches)
    first = [g["a", T0 + SECONDS] for g in got if ("a", T0 + SECONDS) in g]
    # early at the 8th and the 10th second, then at the end with the late record; the last one is too late
    assert first == [(3, T0 + 8), (3, T0 + 10), (4, T0 + SECONDS)]
