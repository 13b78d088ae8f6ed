import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cairn.functions import convert, partitioning, sharding, text
from cairn.functions.identifiers import TableName, quote
from cairn.schema import ColumnDef, TableDef, spark_type, widen


def murmur3(data, seed=sharding.SEED):
    """The public definition of murmur3_x86_32, one value at a time."""
    m = 0xFFFFFFFF
    rot = lambda x, r: (x << r | x >> 32 - r) & m
    h = seed
    for i in range(0, len(data) // 4 * 4, 4):
        k = rot(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
        h = (rot(h ^ k, 13) * 5 + 0xE6546B64) & m
    if tail := data[len(data) // 4 * 4 :]:
        h ^= rot(int.from_bytes(tail, "little") * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_murmur3():
    values = [b"", b"a", b"ab", b"abc", b"abcd", "héllo wörld".encode(), bytes(range(256))] + [str(i).encode() for i in range(300)]
    assert sharding.murmur3(values).tolist() == [murmur3(v) for v in values]
    assert sharding.murmur3([b"test"], 0).tolist() == [-1167338989]  # published vector: 0xba6bd213


def test_record_hash_by_type(spark):
    row = (1, "x", True, b"\x01", dt.date(1970, 1, 11), dt.datetime(1970, 1, 1, 0, 0, 1), Decimal("-1.25"), [1, None, 3], None)
    df = spark.createDataFrame([row], "i long, s string, b boolean, y binary, d date, t timestamp_ntz, n decimal(10,2), a array<int>, z string")
    got = df.select(*[sharding.record_hash(df, [c]).alias(c) for c in df.columns]).first()
    h = lambda v: murmur3(str(v).encode())
    wrap = lambda v: (v + 2**31) % 2**32 - 2**31
    assert (got["i"], got["s"], got["b"], got["y"], got["d"], got["t"]) == (h(1), h("x"), h(1), murmur3(b"\x01"), h(10), h(1_000_000))
    assert got["n"] == murmur3((-125 & 0xFF).to_bytes(1, "little") + bytes(15))
    assert got["a"] == wrap((h(1) * 31 + 0) * 31 + h(3)) and got["z"] == (murmur3(b"") & 0xFFFFFFFF) % 65536
    assert df.select(sharding.record_hash(df, ["i", "s"])).first()[0] == h(1) ^ h("x")


@pytest.mark.parametrize("n", [1, 3, 7, 40, 65536])
def test_shards_deal_the_ranges(spark, n):
    spans = sharding.ranges(n)
    assert spans[0][0] == 0 and spans[-1][1] == 65536 and max(b - a for a, b in spans) - min(b - a for a, b in spans) <= 1
    places = sorted({p for a, b in spans[:50] for p in (a, b - 1)})
    got = spark.createDataFrame([(p,) for p in places], "h int").select("h", sharding.shard_of(F.col("h"), n)).collect()
    assert all(spans[s][0] <= h < spans[s][1] for h, s in got)


def test_writers_hold_whole_shards(spark):
    df = sharding.by_shard(spark.range(500), ["id"], 16, 4).withColumn("p", F.spark_partition_id())
    assert df.select("_shard", "p").distinct().count() == df.select("_shard").distinct().count()


@pytest.mark.parametrize("unit, dashed, suffix, start, stop, following", [
    ("HOUR", False, "2024022823", "2024-02-28 23:00", "2024-02-29 00:00", "2024022900"), ("HOUR", True, "2024-02-28-23", "2024-02-28 23:00", "2024-02-29 00:00", "2024-02-29-00"),
    ("DAY", False, "20240228", "2024-02-28 00:00", "2024-02-29 00:00", "20240229"), ("DAY", True, "2024-02-28", "2024-02-28 00:00", "2024-02-29 00:00", "2024-02-29"),
    ("MONTH", False, "202402", "2024-02-01 00:00", "2024-03-01 00:00", "202403"), ("QUARTER", False, "20241", "2024-01-01 00:00", "2024-04-01 00:00", "20242"),
    ("QUARTER", True, "2024-1", "2024-01-01 00:00", "2024-04-01 00:00", "2024-2"), ("YEAR", False, "2024", "2024-01-01 00:00", "2025-01-01 00:00", "2025"),
])
def test_partitions(spark, unit, dashed, suffix, start, stop, following):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 28, 23, 59, 59),)], "ts timestamp_ntz").withColumn("s", partitioning.suffix(F.col("ts"), unit, dashed))
    s = F.col("s")
    r = df.select("s", partitioning.start(s, unit, dashed).alias("a"), partitioning.stop(s, unit, dashed).alias("z"), partitioning.next_suffix(s, unit, dashed).alias("n"), partitioning.is_legal(s, unit, dashed).alias("ok")).first()
    assert (r["s"], f"{r['a']:%Y-%m-%d %H:%M}", f"{r['z']:%Y-%m-%d %H:%M}", r["n"], r["ok"]) == (suffix, start, stop, following, True)


def test_illegal_suffixes_and_zones(spark):
    df = spark.createDataFrame([("2024x",), ("20245",), ("2024-1",)], "s string")
    assert [r[0] for r in df.select(partitioning.start(F.col("s"), "QUARTER")).collect()] == [None, None, None]
    at = spark.sql("SELECT TIMESTAMP '2024-01-01 00:30:00' AS t")
    assert at.select(partitioning.suffix(F.col("t"), "DAY", zone="America/New_York")).first()[0] == "20231231"


def test_routing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, ds string")
    child = lambda **k: sorted(((r["id"], r["_child"]) for r in partitioning.route(df, "t", F.col("ds"), **k).collect()), key=str)
    assert child(existing=["t_a"], action="get") == [(1, "t_a"), (2, None), (3, None)]
    assert child(existing=["t_a"], action="delete") == [(1, "t_a")]
    assert child(existing=["t_a"], create=True)[1] == (2, "t_b")
    with pytest.raises(Exception, match="no partition"):
        child(existing=["t_a"])


def test_timestamps(spark):
    cases = {"2024-01-02": "2024-01-02 00:00:00", "2024-01-02 03:04:05": "2024-01-02 03:04:05", "2024-01-02T03:04:05.5Z": "2024-01-02 03:04:05.5", "2024-01-02 03:04:05+08": "2024-01-01 19:04:05",
             "2024-01-02T03:04:05+08:00": "2024-01-01 19:04:05", "0000-00-00 00:00:00": "1970-01-01 00:00:00", "junk": None, "2024-13-01": None, "1000": None}
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = {r[0]: r[1] for r in df.select("s", convert.parse_timestamp(F.col("s")).cast("string")).collect()}
    assert got == cases
    assert df.where("s = '1000'").select(convert.parse_timestamp(F.col("s"), True).cast("string")).first()[0] == "1970-01-01 00:00:01"
    assert df.where("s = '2024-01-02'").select(convert.offset_micros(F.col("s"))).first()[0] == 1704153600000000


def test_small_conversions(spark):
    df = spark.createDataFrame([("a\x00b", ["x\x00", None], "1,x,3", "", '{"b": 1,  "a": [2]}', "abc")], "s string, a array<string>, d string, e string, j string, t string")
    c = F.col
    r = df.select(convert.remove_nul(c("s")), convert.remove_nul(c("a"), True), convert.split_array(c("d"), ",", "int4"), convert.split_array(c("e"), ","), convert.empty_as_null(c("e")), convert.normalise_json(c("j")),
                  convert.fit_length(c("t"), "char", 5), convert.fit_length(c("t"), "varchar", 2), convert.compact(c("a"))).first()
    assert list(r) == ["ab", ["x", None], [1, None, 3], None, None, '{"a":[2],"b":1}', "abc  ", "ab", ["x\x00"]]


def test_defaults_and_dirty_rows(spark):
    t = TableDef("t", [ColumnDef("id", "int", False), ColumnDef("s", "varchar(3)", False, "'n/a'::text"), ColumnDef("n", "numeric(4,1)"), ColumnDef("ser", "serial", False)], ["id"])
    df = spark.createDataFrame([(1, None, "1.5"), (2, "toolong", "1"), (3, "ok", "x"), (None, "ok", None)], "id int, s string, n string")
    assert [r["s"] for r in convert.fill_defaults(df, t).orderBy("id").collect() if r["id"]] == ["n/a", "toolong", "ok"]
    good, bad = convert.split_dirty(convert.fill_defaults(df.where("id IS NOT NULL"), t), t, "skip")
    assert [tuple(r) for r in good.collect()] == [(1, "n/a", Decimal("1.5"))]
    assert sorted(r["_problems"][0] for r in bad.collect()) == ["n: not a numeric(4,1)", "s: longer than 3"]
    with pytest.raises(Exception, match="dirty row"):
        convert.split_dirty(df, t)[0].collect()


def test_types_and_ddl(spark):
    assert [spark_type(n).simpleString() for n in ("int8", "NUMERIC(38,12)", "float4[]", "_text", "varchar(9)", "timestamptz", "timestamp", "bytea")] == [
        "bigint", "decimal(38,12)", "array<float>", "array<string>", "string", "timestamp", "timestamp_ntz", "binary"]
    with pytest.raises(ValueError):
        spark_type("int4[][]")
    t = TableDef("ddl_t", [ColumnDef("id", "bigint", False, comment="it's"), ColumnDef("Ds`x", "text", False)], ["id", "Ds`x"], partition_column="Ds`x", properties={"ttl": "9"}, comment="c")
    spark.sql("DROP TABLE IF EXISTS ddl_t")
    spark.sql(t.ddl())
    assert spark.table("ddl_t").columns == ["id", "Ds`x"] and TableDef.from_json(t.to_json()) == t
    for bad in (dict(primary_key=["zz"]), dict(partition_column="b"), dict(primary_key=["b"])):
        with pytest.raises(ValueError):
            TableDef("t", [ColumnDef("a", "int", False), ColumnDef("b", "int")], **{"primary_key": ["a"]} | bad)


def test_widening(spark):
    df = spark.createDataFrame([(1, 2.5, True)], "a short, f float, b boolean")
    target = TableDef("t", [ColumnDef("a", "bigint"), ColumnDef("f", "float8"), ColumnDef("b", "text")]).schema()
    assert tuple(widen(df, target).first()) == (1, 2.5, "true")
    for frame, kind, strict in ((df, target, True), (spark.createDataFrame([(1,)], "a long"), TableDef("t", [ColumnDef("a", "int")]).schema(), False)):
        with pytest.raises(TypeError):
            widen(frame, kind, strict)


def test_text(spark):
    long = "x" * 25
    df = spark.createDataFrame([(1, long), (2, ""), (3, None), (4, "ab")], "id int, t string")
    got = {(r["id"], r["chunk_no"]): r["chunk"] for r in text.chunks(df, "id", "t", 10, 3).collect()}
    assert got == {(1, k): long[k * 7 : k * 7 + 10] for k in range(4) if k * 7 < 22} | {(4, 0): "ab"}
    say = lambda s: spark.createDataFrame([(s,)], "t string").select(text.sentences(F.col("t"))).first()[0]
    assert say('One is 3.5 big. "Two?" she said... End') == ["One is 3.5 big.", '"Two?"', "she said...", "End"]
    assert say("第一句。第二句！”第三……") == ["第一句。", "第二句！”", "第三……"]
    cut = spark.createDataFrame([("aa bb, cc dd ee ffffffffffff. ok",)], "t string").select(text.sized_sentences(F.col("t"), 5)).first()[0]
    assert all(len(p) <= 5 for p in cut) and "".join(cut).replace(" ", "") == "aabb,ccddeeffffffffffff.ok"
    sql = "CREATE TABLE t (a INT) WITH ('connector' = 'x', 'it''s' = 'a)b', 'connector' = 'y'); SELECT 1 /*+ OPTIONS('k'='v') */"
    assert spark.createDataFrame([(sql,)], "t string").select(text.options(F.col("t"))).first()[0] == {"connector": "y", "it's": "a)b", "k": "v"}


def test_names():
    assert TableName.parse("T") == TableName("public", "t") and TableName.parse('S."My ""T"""') == TableName("s", 'My "T"')
    assert quote("ok_1") == "ok_1" and quote("No`pe") == "`No``pe`" and TableName.parse("a.b").sql() == "a.b"
    for bad in ("", "a.b.c", "a..b", '"a'):
        with pytest.raises(ValueError):
            TableName.parse(bad)
