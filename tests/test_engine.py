import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.engine import Engine
from cairn.operators import metrics
from cairn.schema import ColumnDef, TableDef, spark_type, type_name
from cairn.sources import loader
from cairn.sources.changelog_source import write_changelog

TABLE = TableDef("t", [ColumnDef("id", "bigint", False), ColumnDef("name", "text"), ColumnDef("tags", "text[]"), ColumnDef("at", "timestamptz")], ["id"], clustering_key=["name:desc"])


@pytest.fixture
def engine(spark, tmp_path):
    e = Engine(spark, str(tmp_path), buckets=3)
    e.create(TABLE)
    return e


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "name").collect()), key=str)


def test_whole_surface(spark, engine, tmp_path):
    put = lambda data, op="put": spark.createDataFrame([(i, s, op, n) for s, (i, n) in enumerate(data)], "id long, _seq long, _op string, name string")
    engine.put("t", put([(1, "a"), (2, "b"), (1, "c")]))
    engine.put("t", put([(2, None)], "delete"))
    engine.check_and_put("t", put([(1, "b"), (3, "n")]).withColumns({"tags": F.lit(None).cast("array<string>"), "at": F.lit(None).cast("timestamp")}), "name", "greater")
    assert rows(engine.read("t")) == [(1, "c"), (3, "n")] and engine.table("t") == TABLE
    assert [r["id"] for r in engine.scan("t", sort="clustering").collect()] == [1, 3]
    assert rows(engine.get("t", spark.createDataFrame([(3,), (9,)], "id long"), ["name"])) == [(3, "n"), (9, None)]
    engine.register("t")
    assert engine.sql("SELECT count(*) FROM t").first()[0] == 2
    engine.export_csv("t", str(tmp_path / "csv"))
    engine.put("t", put([(1, None), (3, None)], "delete"))
    assert rows(engine.read("t")) == []
    engine.import_csv("t", str(tmp_path / "csv"))
    assert rows(engine.read("t")) == [(1, "c"), (3, "n")]
    log = spark.createDataFrame([(0, 1, 5, 1, 7, "x"), (0, 2, 2, 2, 1, "c")], "_shard int, _lsn long, _event_type int, _ts_us long, id long, name string")
    write_changelog(log, str(tmp_path / "log"))
    assert engine.changes(str(tmp_path / "log"), {0: 1}).select("_lsn").collect() == [(2,)] and engine.changes(str(tmp_path / "log")).count() == 2
    engine.follow("t", engine.changes(str(tmp_path / "log"), streaming=True), str(tmp_path / "cp"), ignore_delete=False).awaitTermination()
    assert rows(engine.read("t")) == [(3, "n"), (7, "x")]
    with pytest.raises(ValueError):
        engine.create(TableDef("k", [ColumnDef("a", "int")]))


def test_loader(spark, engine):
    source = spark.createDataFrame([("1", "a\x00", "x,y", "2024-01-02T03:04:05Z"), ("2", "", "", "junk"), ("1", "z", "q", None)], "c0 string, c1 string, c2 string, c3 string")
    loader.load(source.coalesce(1), engine.keyed("t"), TABLE)
    got = {r["id"]: r for r in engine.read("t").collect()}
    assert got[1]["name"] == "z" and got[1]["tags"] == ["q"] and got[2]["name"] is None and got[2]["tags"] is None and got[2]["at"] is None
    assert loader.map_columns(source, TABLE).first()["at"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    with pytest.raises(ValueError):
        loader.map_columns(source.drop("c3"), TABLE)


def test_metrics(spark):
    df = spark.createDataFrame([(float(i), dt.datetime(2024, 1, 1, 0, i % 20)) for i in range(1000)], "v double, ts timestamp")
    r = metrics.latency(df, "v").first()
    assert (r["count"], r["mean"]) == (1000, 499.5) and abs(r["p99"] - 989) <= 1
    assert metrics.rate(df, "ts").first()["qps1"] == 50 / 60
    seen, watch = metrics.observed(df)
    seen.write.format("noop").mode("overwrite").save()
    assert watch.get == {"count": 1000}


def test_a_log_that_gains_columns(spark, engine, tmp_path):
    path = str(tmp_path / "log")
    base = "_shard int, _lsn long, _event_type int, _ts_us long, id long, name string"
    engine.append_changes(path, spark.createDataFrame([(0, 1, 5, 1, 1, "a"), (0, 2, 5, 1, 2, "b")], base))
    engine.follow_log("t", path, str(tmp_path / "cp"), ignore_delete=False).awaitTermination()
    engine.append_changes(path, spark.createDataFrame([(0, 3, 3, 2, 1, "a", None), (0, 4, 7, 2, 1, "c", [1.5])], base + ", marks array<double>"))
    engine.follow_log("t", path, str(tmp_path / "cp"), ignore_delete=False).awaitTermination()
    assert [tuple(r) for r in engine.read("t").select("id", "name", "marks").orderBy("id").collect()] == [(1, "c", [1.5]), (2, "b", None)]
    assert [(c.name, c.type) for c in engine.table("t").columns][-1] == ("marks", "float8[]")
    engine.expression_upsert("t", spark.createDataFrame([(2, 1, "+")], "id long, _seq long, name string"), {"name": "old.name || excluded.name"})
    assert engine.get("t", spark.createDataFrame([(2,)], "id long"), ["name"]).first()["name"] == "b+"
    assert engine.partitions("t", "DAY", range(2)).children().count() == 0


def test_type_names_are_the_inverse_of_types():
    for name in ("smallint", "int", "bigint", "float4", "float8", "bool", "text", "bytea", "date", "timestamptz", "timestamp", "numeric(12,3)", "int4[]", "int8[]", "text[]", "float8[]"):
        assert type_name(spark_type(name)) == name
    with pytest.raises(ValueError):
        type_name(spark_type("int4[]").__class__(spark_type("int4[]")))
