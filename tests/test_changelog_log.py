import os

import pytest

from cairn import store
from cairn.operators import changelog as cl
from cairn.sources import changelog_source as cs
from cairn.sources.keyed_table import KeyedTable
from cairn.streaming import sinks

LOG = "_shard int, _lsn long, _event_type int, _ts_us long, id long, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def part(spark, data, schema=LOG):
    return spark.createDataFrame(data, schema)


def inserts(shard, lsns, v=0):
    return [(shard, n, cl.INSERT, n * 10, shard * 100 + n, v) for n in lsns]


def test_positions_come_from_the_commits(spark, tmp_path):
    path = str(tmp_path / "log")
    assert cs.latest(spark, path) == {} and cs.commits(spark, path) == []
    cs.write_changelog(part(spark, inserts(0, range(1, 6)) + inserts(1, range(1, 3))), path)
    cs.write_changelog(part(spark, inserts(0, range(6, 9))), path)
    assert cs.latest(spark, path) == {0: 8, 1: 2} and [c.shards for c in cs.commits(spark, path)] == [{"0": [1, 5, 5], "1": [1, 2, 2]}, {"0": [6, 8, 3]}]
    assert len(cs.commits(spark, path, after=0)) == 1
    with pytest.raises(ValueError, match="no change log"):
        cs.subscribe(spark, str(tmp_path / "none"))


def test_commits_without_wanted_records_are_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    for k in range(3):
        cs.write_changelog(part(spark, inserts(0, range(10 * k, 10 * k + 10)) + inserts(1, [k])), path)
    later = cs.subscribe(spark, path, {0: 14, 1: 1}, streaming=False)
    assert {r["_lsn"] for r in later.where("_shard = 0").collect()} == set(range(15, 30)) and rows(later.where("_shard = 1").select("_lsn")) == [(2,)]
    folders = lambda df: {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}
    assert len(folders(later)) == 2 and len(folders(cs.subscribe(spark, path, streaming=False))) == 3
    assert "PushedFilters: [" in later._jdf.queryExecution().executedPlan().toString() and cs.subscribe(spark, path, {0: 29, 1: 2}, streaming=False).count() == 0
    assert cs.subscribe(spark, path, {0: 25}, streaming=False).count() == 4 + 3  # the other shard from the oldest


def test_what_a_writer_leaves_half_done_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "log")
    cs.write_changelog(part(spark, inserts(0, [1])), path)
    part(spark, inserts(0, [2])).write.parquet(f"{path}/staged/half")
    assert cs.subscribe(spark, path, streaming=False).count() == 1
    stream = cs.subscribe(spark, path)
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], 2)
    table.create(part(spark, []).select("id", "v"))
    sinks.upsert(stream, table, str(tmp_path / "cp")).awaitTermination()
    assert rows(table.read()) == [(1, 0)]


def test_two_writers(spark, tmp_path, monkeypatch):
    path, real = str(tmp_path / "log"), store.create
    cs.write_changelog(part(spark, inserts(0, [1])), path)

    def late(spark_, file, text):
        monkeypatch.setattr(cs.store, "create", real)
        cs.write_changelog(part(spark, inserts(1, [7])), path)
        return real(spark_, file, text)

    monkeypatch.setattr(cs.store, "create", late)
    cs.write_changelog(part(spark, inserts(0, [2])), path)
    assert [c.number for c in cs.commits(spark, path)] == [0, 1, 2] and cs.latest(spark, path) == {0: 2, 1: 7}
    cs.write_changelog(part(spark, inserts(3, [1])), path, "overwrite")
    assert cs.latest(spark, path) == {3: 1} and cs.subscribe(spark, path, streaming=False).count() == 1


def test_columns_change_while_a_stream_runs(spark, tmp_path):
    """A new column and a wider type reach the table without a restart; an update cut in two by the change is held."""
    path = str(tmp_path / "log")
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], 2)
    table.create(part(spark, [(0, 0, 5, 0, 1, 5)]).select("id", "v"))
    cs.write_changelog(part(spark, [(0, 1, cl.INSERT, 1, 2, 7), (0, 2, cl.BEFORE_UPDATE, 2, 1, 5)]), path)
    step = sinks.merging(table, str(tmp_path / "cp"), ignore_delete=False, evolve=True)
    query = cs.follow(spark, path, step, str(tmp_path / "cp"), available_now=False)
    query.processAllAvailable()
    assert rows(table.read()) == [(1, 5), (2, 7)]
    wider = "_shard int, _lsn long, _event_type int, _ts_us long, id long, v long, name string"
    cs.write_changelog(part(spark, [(0, 3, cl.AFTER_UPDATE, 2, 1, 1 << 40, "one"), (0, 4, cl.INSERT, 3, 3, 9, None)], wider), path)
    query.processAllAvailable()
    assert rows(table.read()) == [(1, 1 << 40, "one"), (2, 7, None), (3, 9, None)] and table.read().dtypes[1] == ("v", "bigint")
    cs.write_changelog(part(spark, [(0, 5, cl.DELETE, 4, 2, 7)]), path)  # an old writer goes on
    query.processAllAvailable()
    query.stop()
    assert rows(table.read()) == [(1, 1 << 40, "one"), (3, 9, None)]
    assert cs.subscribe(spark, path, streaming=False).columns == wider.replace(" int", "").replace(" long", "").replace(" string", "").split(", ")
    with pytest.raises(ValueError, match="column v"):
        cs.write_changelog(part(spark, [(0, 9, 5, 1, 1, "x")], LOG.replace("v int", "v string")), path)
