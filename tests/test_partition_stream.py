import datetime as dt
import random

import pytest

from cairn import store
from cairn.operators import changelog as cl
from cairn.streaming.partitions import PartitionSubscription, heartbeats

LOG = "_shard int, _lsn long, _event_type int, _ts_us long, id long"
MINUTE = 60_000_000
HOUR = 60 * MINUTE
BASE = 1_700_000_000 // 3600 * HOUR


def name(us):
    return dt.datetime.fromtimestamp(us // 1_000_000, dt.UTC).strftime("%Y%m%d%H")


def interpreter(batches, shards, lateness):
    """One record after the other: rows kept by partition, and after each batch what is open and what has closed."""
    seen, kept, opened, closed, after = {}, {}, [], [], []
    for batch in batches:
        for shard, _, kind, ts, i in sorted(batch, key=lambda r: (r[2] == cl.HEARTBEAT, r[0], r[1])):
            seen[shard] = max(seen.get(shard, ts), ts)
            end = ts // HOUR * HOUR + HOUR
            if kind != cl.HEARTBEAT and seen[shard] < end + lateness:
                kept.setdefault(name(ts), set()).add(i)
        records = [r[3] for r in batch if r[2] != cl.HEARTBEAT]
        if seen and (opened or records):
            begin = opened[-1] + HOUR if opened else min(records) // HOUR * HOUR
            opened += range(begin, max(seen.values()) + 1, HOUR)
        if all(s in seen for s in shards):
            low = min(seen[s] for s in shards)
            closed += [o for o in opened if o not in closed and low >= o + HOUR + lateness]
        after.append(({name(o) for o in opened} - {name(o) for o in closed}, {name(o) for o in closed}))
    return kept, after


def run(spark, path, batches, shards, lateness, again=()):
    followed = PartitionSubscription(spark, path, "HOUR", shards, lateness // 1_000_000)
    after, like = [], None
    for number, batch in enumerate(batches):
        like = spark.createDataFrame(batch, LOG).repartition(2)
        for _ in range(1 + (number in again)):
            followed.step(like, number)
        events = followed.children().collect()
        closed = {r["partition"] for r in events if r["event"] == "close"}
        after.append(({r["partition"] for r in events if r["event"] == "open"} - closed, closed))
        assert set(followed._state(number)["open"]) == after[-1][0]
    kept = {}
    for r in followed.rows(like).collect():
        kept.setdefault(str(r["_partition"]), []).append(r["id"])
    assert all(len(ids) == len(set(ids)) for ids in kept.values())
    done = {str(r["_partition"]) for r in followed.rows(like, closed_only=True).collect()}
    assert done == after[-1][1] & set(kept)
    return {p: set(ids) for p, ids in kept.items()}, after


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_sequential_interpreter(spark, tmp_path, seed):
    rng = random.Random(seed)
    at, lsn, batches = {s: BASE + rng.randint(0, 50) * MINUTE for s in range(3)}, {s: 0 for s in range(3)}, []
    for b in range(5):
        batch = []
        for s in range(3):
            for _ in range(rng.randint(0, 6)):
                at[s] += rng.randint(0, 40) * MINUTE
                lsn[s] += 1
                batch.append((s, lsn[s], cl.INSERT, at[s] - rng.choice([0, 0, 10, 90, 200]) * MINUTE, s * 1000 + lsn[s]))
        if b % 2:
            batch.append((rng.randint(0, 2), -1, cl.HEARTBEAT, max(at.values()), None))
        batches.append(batch)
    expected = interpreter(batches, range(3), 10 * MINUTE)
    assert run(spark, str(tmp_path / "p"), batches, range(3), 10 * MINUTE, again=(1, 3)) == expected


def test_an_idle_shard_and_its_heartbeats(spark, tmp_path):
    busy = [[(0, k, cl.INSERT, BASE + k * HOUR, k)] for k in range(4)]
    _, silent = run(spark, str(tmp_path / "silent"), busy, [0, 1], MINUTE)
    assert all(not closed for _, closed in silent)
    like = spark.createDataFrame([], LOG)
    beats = [tuple(r) for r in heartbeats(like, {1: BASE + 3 * HOUR}).collect()]
    assert beats == [(1, -1, cl.HEARTBEAT, BASE + 3 * HOUR, None)]
    _, moved = run(spark, str(tmp_path / "moved"), [*busy, beats], [0, 1], MINUTE)
    assert moved[-1] == ({name(BASE + k * HOUR) for k in (2, 3)}, {name(BASE + k * HOUR) for k in (0, 1)})


def test_late_rows_and_partitions_without_any(spark, tmp_path):
    batches = [[(0, 1, cl.INSERT, BASE, 1)], [(0, 2, cl.INSERT, BASE + 3 * HOUR, 2), (0, 3, cl.INSERT, BASE + HOUR, 3)], [(0, 4, cl.INSERT, BASE + 2 * HOUR + 59 * MINUTE, 4)]]
    kept, after = run(spark, str(tmp_path / "p"), batches, [0], 30 * MINUTE)
    assert kept == {name(BASE): {1}, name(BASE + 2 * HOUR): {4}, name(BASE + 3 * HOUR): {2}} and (kept, after) == interpreter(batches, [0], 30 * MINUTE)
    assert after[1] == ({name(BASE + 2 * HOUR), name(BASE + 3 * HOUR)}, {name(BASE), name(BASE + HOUR)})


def test_empty_batches(spark, tmp_path):
    kept, after = run(spark, str(tmp_path / "p"), [[], [(0, 1, cl.INSERT, BASE, 1)], []], [0], MINUTE)
    assert kept == {name(BASE): {1}} and after == [(set(), set()), ({name(BASE)}, set()), ({name(BASE)}, set())]
    assert set(store.names(spark, str(tmp_path / "p" / "state"))) >= {"2.json"}
