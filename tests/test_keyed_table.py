import os

import pytest
from pyspark.sql import functions as F

from cairn import store
from cairn.operators import changelog as cl
from cairn.operators import mutate
from cairn.sources.keyed_table import KeyedTable
from cairn.streaming.sinks import HeldDeletes, as_mutations

LOG = "_shard int, _lsn long, _event_type int, _ts_us long, id long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def puts(spark, ids, v, seq=1):
    return spark.createDataFrame([(i, f"{v}{i}", seq) for i in ids], "id long, v string, _seq long")


def buckets_of(df):
    return {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=8)
    t.create(puts(spark, range(100), "a").drop("_seq"))
    return t


def test_a_get_reads_the_buckets_of_its_keys(spark, table):
    keys = spark.createDataFrame([(7,), (7,), (500,)], "id long")
    found = table.get(keys, ["v"])
    assert rows(found) == [(500, None), (7, "a7"), (7, "a7")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    version = table.version()
    assert "PushedFilters: [In(id" in plan and len(buckets_of(table._stored(version, table._touched(keys, version)))) <= 2 < len(buckets_of(table.read())) == 8
    many = table.get(spark.range(0, 200, 2).withColumnRenamed("id", "id"))
    assert many.count() == 100 and many.where("v IS NULL").count() == 50
    # a key of a narrower type goes to the same bucket
    assert rows(table.get(spark.createDataFrame([(3,)], "id int"))) == [(3, "a3")]
    with pytest.raises(Exception, match="is null"):
        table.get(spark.createDataFrame([(None,)], "id long")).collect()


def test_a_reader_goes_on_with_the_rows_it_planned_with(spark, table):
    before = table.read()
    table.merge(puts(spark, range(100), "b"))
    table.create(puts(spark, range(5), "c").drop("_seq"))
    assert rows(before) == [(i, f"a{i}") for i in sorted(range(100), key=lambda i: f"({i}, 'a{i}')")]
    assert rows(table.read()) == [(i, f"c{i}") for i in range(5)] and table.read(1).count() == 100
    table.vacuum(0)
    assert table._numbers() == [2] and table.read().count() == 5 and len(store.names(spark, table.path)) == 2
    with pytest.raises(ValueError, match="no version"):
        table.read(0)


def test_a_merge_that_stops_leaves_the_table(spark, table):
    bad = puts(spark, range(50), "b").withColumn("v", F.when(F.col("id") == 40, F.raise_error(F.lit("stop")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        table.merge(bad)
    assert table.version().number == 0 and table.read().where("v LIKE 'a%'").count() == 100
    table.vacuum(0)
    assert len(store.names(spark, table.path)) == 2


def test_of_two_writers_the_second_starts_anew(spark, table):
    first = table._publish

    def second(version):
        table._publish = first
        KeyedTable(spark, table.path, ["id"]).merge(puts(spark, [1, 200], "x"))
        return first(version)

    table._publish = second
    table.merge(puts(spark, [1, 300], "y", 2))
    got = {r["id"]: r["v"] for r in table.read().collect()}
    assert (got[1], got[200], got[300], len(got)) == ("y1", "x200", "y300", 102) and table.version().number == 2


def test_buckets_grow_with_the_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "g"), ["id"], buckets=1, bucket_rows=30)
    table.create(spark.createDataFrame([], "id long, v string"))
    held = {}
    for k, ids in enumerate((range(10), range(5, 65), range(60, 320), range(300))):
        table.merge(puts(spark, ids, f"m{k}_"))
        held |= {i: f"m{k}_{i}" for i in ids}
        version = table.version()
        assert sum(version.rows) == len(held) and version.buckets == -(-len(held) // 30) and max(version.rows) <= 4 * 30
    assert rows(table.read()) == sorted(held.items(), key=str)
    assert rows(table.get(spark.createDataFrame([(i,) for i in (0, 64, 319, 999)], "id long"))) == rows(spark.createDataFrame([(i, held.get(i)) for i in (0, 64, 319, 999)], "id long, v string"))
    table.merge(spark.createDataFrame([(i, 1, "delete", None) for i in range(320)], "id long, _seq long, _op string, v string"))
    assert rows(table.read()) == [] and sum(table.version().rows) == 0


def test_growth_from_any_number_rewrites_only_what_is_split(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "g"), ["id"], buckets=3, bucket_rows=20)
    table.create(puts(spark, range(59), "a").drop("_seq"))
    before = table.version()
    table.merge(puts(spark, range(59, 62), "a"))
    after = table.version()
    assert after.buckets == 4 and after.folder(1) in {before.folder(1), after.folder(1)} and len({table._parent(before, b) for b in range(3, 4)}) == 1
    for _ in range(3):
        table.merge(puts(spark, range(200), "b"))
    assert rows(table.read()) == sorted(((i, f"b{i}") for i in range(200)), key=str) and table.version().buckets == 10


def test_a_batch_that_comes_again_is_left_out(spark, table):
    add = spark.createDataFrame([(1, "+", 1)], "id long, v string, _seq long")
    for number in (0, 0, 1, 0, 1):
        table.expression_upsert(add, {"v": "old.v || excluded.v"}, once=("stream", number))
    assert rows(table.get(spark.createDataFrame([(1,)], "id long"))) == [(1, "a1++")]
    table.merge(puts(spark, [], "z"), once=("stream", 5))
    assert table.version().applied == {"stream": 5}


def test_columns_are_added_and_made_wider(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "w"), ["id"], buckets=2)
    table.create(spark.createDataFrame([(1, 5, 1.5)], "id long, n int, f float"))
    table.merge(spark.createDataFrame([(2, 1 << 40, 2.5, "new", 1)], "id long, n long, f double, s string, _seq long"), evolve=True)
    table.merge(spark.createDataFrame([(3, 7, 1)], "id long, n int, _seq long"), evolve=True)
    assert rows(table.read()) == [(1, 5, 1.5, None), (2, 1 << 40, 2.5, "new"), (3, 7, None, None)]
    assert table.read().dtypes == [("id", "bigint"), ("n", "bigint"), ("f", "double"), ("s", "string")]


EVENTS = [
    (0, 1, cl.INSERT, 1, "a"), (0, 2, cl.BEFORE_UPDATE, 0, "v0"), (0, 3, cl.AFTER_UPDATE, 0, "w0"), (0, 4, cl.BEFORE_UPDATE, 1, "a"), (0, 5, cl.AFTER_UPDATE, 1, "b"),
    (1, 1, cl.DELETE, 10, "v10"), (1, 2, cl.BEFORE_UPDATE, 11, "v11"), (1, 3, cl.AFTER_UPDATE, 11, "w11"), (0, 6, cl.BEFORE_UPDATE, 0, "w0"), (1, 4, cl.INSERT, 12, "n"), (0, 7, cl.AFTER_UPDATE, 0, "x0"),
]


def log_of(spark, events):
    return spark.createDataFrame([(s, n, kind, 0, i, v) for s, n, kind, i, v in events], LOG)


def test_no_cut_ever_shows_an_updated_row_missing(spark, tmp_path):
    base = puts(spark, [0, 10, 11], "v").drop("_seq")
    whole = mutate.apply_mutations(base, as_mutations(log_of(spark, EVENTS), False), ["id"])
    expected = [(0, "x0"), (1, "b"), (11, "w11"), (12, "n")]
    assert rows(whole) == sorted(expected, key=str)
    for cut in range(1, len(EVENTS)):
        table = KeyedTable(spark, str(tmp_path / f"t{cut}"), ["id"], buckets=2)
        table.create(base)
        held = HeldDeletes(table, str(tmp_path / f"h{cut}"))
        for number, part in enumerate((EVENTS[:cut], EVENTS[cut:])):
            batch = log_of(spark, part)
            for _ in range(1 + (cut % 4 == 0)):  # some batches come again
                table.merge(as_mutations(held.split(batch, number), False), once=("s", number))
            seen = {r["id"] for r in table.read().collect()}
            assert {0, 11} <= seen and (number or {e[3] for e in part if e[2] == cl.INSERT} <= seen)
        assert rows(table.read()) == sorted(expected, key=str)
        assert held.held(1, batch).count() == 0


def test_an_update_that_changes_the_key(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    table.create(puts(spark, [1], "v").drop("_seq"))
    held = HeldDeletes(table, str(tmp_path / "h"))
    step = lambda n, events: table.merge(as_mutations(held.split(log_of(spark, events), n), False), once=("s", n))
    step(0, [(0, 1, cl.BEFORE_UPDATE, 1, "v1")])
    step(1, [(1, 1, cl.INSERT, 9, "n")])  # another shard goes on: it still waits
    assert {r["id"] for r in table.read().collect()} == {1, 9}
    step(2, [(0, 2, cl.AFTER_UPDATE, 2, "v1")])  # its own shard has gone on without it
    assert {r["id"] for r in table.read().collect()} == {2, 9}
    step(3, [(0, 3, cl.BEFORE_UPDATE, 2, "v1")])
    held.release(log_of(spark, []))
    assert {r["id"] for r in table.read().collect()} == {9}


def test_conditional_writes_that_cannot_be_made(spark, table):
    log = lambda rows: spark.createDataFrame(rows, "id long, v string, _seq long, _op string")
    for bad, told in (((None, "x", 1, "put"), "id is null"), ((1, None, 1, "delete"), "v is null")):
        with pytest.raises(Exception, match=told):
            table.check_and_put(log([(2, "z", 1, "put"), bad]), "v", "greater")
    with pytest.raises(ValueError, match="no such operator"):
        table.check_and_put(log([(1, "x", 1, "put")]), "v", "like")
    with pytest.raises(ValueError, match="not set"):
        table.check_and_put(spark.createDataFrame([(1, 1)], "id long, _seq long"), "v", "greater")
    assert table.version().number == 0
    table.check_and_put(log([(1, None, 1, "delete"), (2, None, 1, "put"), (3, "zz", 1, "put")]), "v", "is_not_null")
    assert {r["id"]: r["v"] for r in table.get(spark.createDataFrame([(1,), (2,), (3,)], "id long")).collect()} == {1: None, 2: None, 3: "zz"} and table.read().count() == 99
    assert mutate.checked_log(log([(1, "x", 1, "put")]).withColumn("p", F.lit("a")), ["id"], "v", "less", partition="p").count() == 1


def test_whole_folders_are_read_by_one_path(spark, table):
    version = table.version()
    assert version.places(None) == (version.folders, []) and len(version.places([0, 3])[1]) == 2
    table.merge(puts(spark, [1, 2], "b"))
    version = table.version()
    whole, single = version.places(None)
    assert whole == [version.folders[1]] and len(single) == 8 - version.held[1] and version.held[0] == 8
    assert rows(table.read()) == sorted(((i, f"{'b' if i in (1, 2) else 'a'}{i}") for i in range(100)), key=str) and table.read().columns == ["id", "v"]
