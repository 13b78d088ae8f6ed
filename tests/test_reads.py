import pytest
from pyspark.sql import functions as F

from cairn.operators import lookup, scan


@pytest.fixture
def t(spark):
    return spark.createDataFrame([(1, "a", 3), (2, None, 1), (3, "c", None), (4, "a", 2)], "id long, name string, n int")


def test_get_answers_every_request(spark, t):
    keys = spark.createDataFrame([(3,), (9,), (3,)], "id long")
    assert sorted(map(tuple, scan.get(t, keys, ["id"], ["n", "name"]).collect())) == [(3, "c", None), (3, "c", None), (9, None, None)]
    with pytest.raises(Exception, match="null"):
        scan.get(t, spark.createDataFrame([(None,)], "id long"), ["id"]).collect()
    with pytest.raises(ValueError):
        scan.get_values(spark, t, ["id"], [(None,)])


def test_scan_order_is_ascending_with_nulls_last(t):
    assert [r["id"] for r in scan.scan(t, sort=["n:desc"]).collect()] == [2, 4, 1, 3]
    assert [r["id"] for r in scan.scan(t, {"name": "a"}, sort=["n"], limit=1).collect()] == [4]
    assert scan.scan(t, columns=["n", "id", "n"]).columns == ["id", "n"]


def test_ranges_are_half_open(t):
    ids = lambda *r: sorted(x["id"] for x in scan.scan(t, between={"id": r}).collect())
    assert (ids(2, 4), ids(None, 2), ids(3, None)) == ([2, 3], [1], [3, 4])
    for bad in ({"equal": {"name": None}}, {"between": {"id": (None, None)}}, {"columns": ["zz"]}):
        with pytest.raises(ValueError):
            scan.scan(t, **bad)


def test_filters_and_columns_reach_the_file(spark, t, tmp_path, capsys):
    t.write.parquet(str(tmp_path / "t"))
    scan.scan(spark.read.parquet(str(tmp_path / "t")), {"id": 1}, columns=["name"]).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(id,1)" in plan and "ReadSchema: struct<id:bigint,name:string>" in plan


def test_cursor(t):
    assert [r["id"] for r in scan.cursor(scan.scan(t, sort=["id"]))] == [1, 2, 3, 4]


def test_lookup_or_insert_gives_dense_ids(spark):
    dim = spark.createDataFrame([("x", 7, "old")], "uid string, id int, note string")
    facts = spark.createDataFrame([(u,) for u in ["x", "b", "a", "b", None, *map(str, range(50))]], "u string")
    got, grown = lookup.lookup_or_insert(facts, dim, {"u": "uid"}, "id")
    ids = {r["uid"]: r["id"] for r in grown.collect()}
    assert ids["x"] == 7 and sorted(ids.values()) == list(range(7, 7 + len(ids)))
    assert [u for u, _ in sorted(ids.items(), key=lambda x: x[1])][1:] == sorted(u for u in ids if u != "x")
    assert got.count() == facts.count() and got.where("u IS NULL").first()["id"] is None


def test_lookup_one_to_many(spark):
    facts = spark.createDataFrame([(1, "p"), (2, "p"), (None, "p")], "k int, d string")
    dim = spark.createDataFrame([(1, "p", "v1"), (1, "p", "v2"), (1, "q", "v3")], "key int, d string, v string").withColumnRenamed("d", "part")
    got = lookup.lookup(facts, dim, {"k": "key", "d": "part"}, ["v"])
    assert sorted(((r["k"], r["v"]) for r in got.collect()), key=str) == sorted([(1, "v1"), (1, "v2"), (2, None), (None, None)], key=str)
    assert got.columns == ["k", "d", "v"] and got.where(F.col("v").isNotNull()).count() == 2


def test_lookups_with_many_pairs_are_spread_by_pairs(spark, monkeypatch):
    facts = spark.createDataFrame([(k, i % 5, i) for i in range(300) for k in (1, 2, None)] + [(9, 0, 1)], "k int, d int, i int")
    dim = spark.createDataFrame([(k, i % 5, i) for i in range(200) for k in (1, 3, None)] + [(2, 4, 7)], "key long, part int, v int")
    monkeypatch.setattr(lookup, "SIDE_ROWS", 10)
    monkeypatch.setattr(lookup, "TASK_PAIRS", 500)
    for how in ("left", "inner"):
        want = lookup.lookup(facts, dim, {"k": "key", "d": "part"}, ["v"], how)
        got = lookup.lookup_many(facts, dim, {"k": "key", "d": "part"}, ["v"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        pairs = [n for n in got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
        assert len(pairs) > 8 and max(pairs) < sum(pairs) / 4
