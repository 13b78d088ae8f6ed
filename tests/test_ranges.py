"""Numbers, running values and percentiles over range partitions, and tables opened again."""

import random

import pytest
from pyspark.sql import functions as F

from cairn.functions import sharding
from cairn.operators import lookup, mutate, ranges, retrieval
from cairn.schema import ColumnDef, TableDef
from cairn.sources import catalog, loader
from cairn.sources.keyed_table import KeyedTable


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_ids_with_wide_rows(spark, adaptive):
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        rows = spark.range(60_000).select(F.xxhash64("id").alias("k"), F.repeat(F.sha2(F.col("id").cast("string").cast("binary"), 256), F.lit(2)).alias("wide"))
        got = lookup.dense_ids(rows, ["k"], 5).select("k", "wide", "id").collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert [r["id"] for r in sorted(got, key=lambda r: r["k"])] == list(range(6, 60_006)) and all(len(r["wide"]) == 128 for r in got)


def test_running_values_by_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(0, 99)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(7)
    sums, best = {}, {}
    for g, o, v in rows:
        sums[g] = sums.get(g, 0) + v
        best[g] = max(best.get(g, -1), v)
        rows[o] = (g, o, v, sums[g], best[g])
    got = ranges.running_max(ranges.running_sum(df, "s", F.col("v"), ["g"], ["o"]), "m", F.col("v"), ["g"], ["o"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == rows
    assert ranges.numbered(df.limit(0), "n", ["g"], ["o"]).collect() == []


def test_percentiles_equal_sparks(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.choice("abc"), rng.choice([None, float(rng.randint(0, 30)), rng.random()])) for _ in range(700)] + [("one", 4.0), ("none", None)], "g string, v double")
    plain = {r["g"]: tuple(r[1:]) for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.99)).alias("x"), F.percentile("v", F.lit(0.5)).alias("y")).collect() if r["x"] is not None}
    got = {r["g"]: tuple(r[1:]) for r in ranges.percentiles(df, "v", {"x": 0.99, "y": 0.5}, ["g"]).collect()}
    assert got.keys() == plain.keys() and all(abs(a - b) < 1e-9 for g in got for a, b in zip(got[g], plain[g], strict=True))
    assert abs(ranges.percentiles(df, "v", {"x": 0.5}).first()["x"] - df.select(F.percentile("v", F.lit(0.5))).first()[0]) < 1e-9


def test_an_open_table_keeps_its_buckets(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a") for i in range(50)], "id long, v string")
    KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=8).create(rows)
    again = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    again.merge(rows.withColumns({"_seq": F.col("id"), "v": F.lit("b")}))
    assert again.buckets == 8 and sorted(map(tuple, again.read().collect())) == [(i, "b") for i in range(50)]
    with pytest.raises(ValueError, match="8 buckets"):
        KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=64).merge(rows.withColumn("_seq", F.col("id")))
    with pytest.raises(ValueError, match="no keyed table"):
        KeyedTable(spark, str(tmp_path / "none"), ["id"]).merge(rows.withColumn("_seq", F.col("id")))
    again.create(rows.limit(3))
    assert again.read().count() == 3 and KeyedTable(spark, str(tmp_path / "t"), ["id"]).buckets == 64


def test_columns_added_in_mid_stream(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    table.create(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    table.merge(spark.createDataFrame([(2, "c", 5, 1), (3, "d", None, 1)], "id long, v string, n int, _seq long"), evolve=True)
    assert sorted(map(tuple, KeyedTable(spark, str(tmp_path / "t"), ["id"]).read().collect())) == [(1, "a", None), (2, "c", 5), (3, "d", None)]
    with pytest.raises(ValueError, match="another type"):
        table.merge(spark.createDataFrame([(2, "x", 1)], "id long, n string, _seq long"), evolve=True)


def test_dirty_rows_of_a_load(spark, tmp_path):
    shape = TableDef("t", [ColumnDef("id", "bigint", False), ColumnDef("n", "int")], ["id"])
    source = spark.createDataFrame([("1", "5"), ("2", "five"), ("3", "")], "a string, b string")
    for policy, left in ((loader.NULL, [(1, 5), (2, None), (3, None)]), (loader.SKIP, [(1, 5), (3, None)])):
        table = KeyedTable(spark, str(tmp_path / policy), ["id"], buckets=2)
        table.create(spark.createDataFrame([], shape.schema()))
        bad = loader.load(source, table, shape, dirty=policy)
        assert sorted(map(tuple, table.read().collect())) == left and [(r["id"], r["_problems"]) for r in bad.collect()] == [(2, ["n"])]
    with pytest.raises(Exception, match="dirty row: n"):
        loader.load(source, table, shape, dirty=loader.EXCEPTION)


def test_conditional_puts_equal_the_fold(spark):
    rng = random.Random(12)
    base = spark.createDataFrame([(k, None if k % 4 == 0 else rng.randint(0, 9), f"b{k}") for k in range(20)], "k long, v int, s string")
    log = [(rng.randrange(30), i, rng.choice([None, *range(12)]), f"c{i}") for i in range(300)]
    changes = spark.createDataFrame(log, "k long, _seq long, v int, s string").repartition(5)
    for operator in ("greater", "less"):
        for null_as in (None, "5"):
            fast = mutate.check_and_put(base, changes, ["k"], "v", operator, null_as=null_as)
            slow = mutate.check_and_put(base, changes.withColumn("_op", F.lit("put")), ["k"], "v", operator, null_as=null_as)
            assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    with pytest.raises(ValueError, match="not set"):
        mutate.check_and_put(base, changes.drop("v"), ["k"], "v", "greater")


def test_generated_columns_do_not_place_a_row():
    table = TableDef("t", [ColumnDef("a", "int", False), ColumnDef("b", "int", False, generated=True)], ["a", "b"])
    assert sharding.hash_columns(table) == ["a"]


def test_overwrite_replaces_rows_and_columns(spark):
    spark.sql("DROP TABLE IF EXISTS over_u")
    for rows in (spark.range(3), spark.range(9), spark.range(2).withColumn("x", F.lit("a"))):
        catalog.overwrite_table(rows, "over_u")
        assert spark.table("over_u").count() == rows.count() and spark.table("over_u").columns == rows.columns
    catalog.overwrite_table(spark.table("over_u").where("id > 0"), "over_u")
    assert spark.table("over_u").count() == 1


def test_blocks_of_queries(spark):
    v = spark.createDataFrame([(i, [1000.0 + i * 1e-4, 1000.0]) for i in range(60)], "vec_id long, embedding array<double>").repartition(3)
    got = retrieval.nearest_for(v.where("vec_id % 5 = 0"), v, 3, block=4).collect()
    assert len(got) == 36
    for q in range(0, 60, 5):
        near = sorted(range(60), key=lambda i: (((1000.0 + i * 1e-4) - (1000.0 + q * 1e-4)) ** 2, i))[:3]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == near
