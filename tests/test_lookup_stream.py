import os

import pytest
from pyspark.sql import functions as F

from cairn.functions import convert
from cairn.schema import ColumnDef, TableDef
from cairn.sources import catalog
from cairn.sources.keyed_table import KeyedTable
from cairn.streaming.lookups import enriched, insert_missing, lookup_stream, to_folder, written


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def dim(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "dim"), ["uid"], buckets=8)
    t.create(spark.createDataFrame([(f"u{i}", i, f"n{i}") for i in range(1, 6)], "uid string, n long, name string"))
    return t


def test_a_dimension_that_changes_meanwhile(spark, dim, tmp_path):
    facts = spark.createDataFrame([(1, "u1"), (2, "u9"), (3, None), (4, "u1")], "i int, user string")
    facts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(facts.schema).parquet(str(tmp_path / "in"))
    run = lambda: lookup_stream(stream, dim, {"user": "uid"}, to_folder(str(tmp_path / "out")), str(tmp_path / "cp"), ["name"]).awaitTermination()
    like = facts.withColumn("name", F.lit(""))
    run()
    assert rows(written(like, str(tmp_path / "out"))) == [(1, "u1", "n1"), (2, "u9", None), (3, None, None), (4, "u1", "n1")]
    dim.merge(spark.createDataFrame([("u1", "new", 1), ("u9", "nine", 1)], "uid string, name string, _seq int"), mode="update")
    facts.withColumn("i", F.col("i") + 10).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert rows(written(like, str(tmp_path / "out")).where("i > 10")) == [(11, "u1", "new"), (12, "u9", "nine"), (13, None, None), (14, "u1", "new")]


def test_missing_keys_are_added_once(spark, dim, tmp_path):
    batch = spark.createDataFrame([("u2",), ("x",), ("b",), ("x",), (None,)], "user string")
    for _ in range(2):
        insert_missing(batch, dim, {"user": "uid"}, "n", str(tmp_path), 0)
    assert rows(dim.read().where("n > 5").select("uid", "n")) == [("b", 6), ("x", 7)]
    assert rows(enriched(batch, dim, {"user": "uid"}, ["n"])) == [("b", 6), ("u2", 2), ("x", 7), ("x", 7), (None, None)]
    insert_missing(spark.createDataFrame([("a",)], "user string"), dim, {"user": "uid"}, "n", str(tmp_path), 1)
    assert dim.read().where("uid = 'a'").first()["n"] == 8
    with pytest.raises(ValueError, match="whole key"):
        enriched(batch, dim, {"user": "name"})


def test_only_the_buckets_of_the_batch_are_read(spark, dim):
    found = enriched(spark.createDataFrame([("u1",)], "user string"), dim, {"user": "uid"})
    assert len([f for f in found.inputFiles() if "_bucket=" in f]) <= 1


def test_one_dirty_row_is_skipped_by_name(spark):
    table = TableDef("t", [ColumnDef("id", "int", False), ColumnDef("v", "int")], ["id"])
    df = spark.createDataFrame([("1", "2", 10), ("x", "1", 11), ("3", "4", 12)], "id string, v string, at int")
    good, bad = convert.split_dirty(df, table, "skip_once", once=F.col("at") == 11)
    assert rows(good) == [(1, 2), (3, 4)] and bad.count() == 1
    with pytest.raises(Exception, match="dirty row"):
        convert.split_dirty(df, table, "skip_once", once=F.col("at") == 12)[0].collect()
    for wrong in (dict(policy="skip_once"), dict(policy="skip", once=F.lit(True)), dict(policy="other")):
        with pytest.raises(ValueError):
            convert.split_dirty(df, table, **wrong)


def test_overwrite_leaves_readers_alone(spark):
    spark.sql("DROP TABLE IF EXISTS kept_t")
    catalog.overwrite_table(spark.range(3), "kept_t")
    before = spark.table("kept_t")
    first = before.inputFiles()
    catalog.overwrite_table(spark.range(7).withColumn("more", F.lit("m")), "kept_t")
    assert before.count() == 3 and spark.table("kept_t").count() == 7 and spark.table("kept_t").columns == ["id", "more"]
    catalog.overwrite_table(spark.range(2).withColumn("more", F.lit("m")), "kept_t", grace=0)
    assert spark.table("kept_t").count() == 2 and not any(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in first)
    catalog.overwrite_table(spark.createDataFrame([("a",)], "id string"), "kept_t")
    assert rows(spark.table("kept_t")) == [("a",)]
    spark.sql("DROP TABLE kept_t")


def test_children_of_a_partitioned_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS parts_t")
    rows_ = [(1, "a b"), (2, "it's"), (3, "x=1/2%"), (4, None), (5, "a b")]
    spark.createDataFrame(rows_, "id int, p string").write.partitionBy("p").option("path", str(tmp_path / "p")).saveAsTable("parts_t")
    found = {r["value"]: r for r in catalog.children(spark, "parts_t").collect()}
    assert set(found) == {"a b", "it's", "x=1/2%", None} and found["a b"]["child"] == "parts_t_a b"
    assert spark.read.schema("id int").parquet(found["a b"]["location"]).count() == 2
    spark.sql("DROP TABLE parts_t")
