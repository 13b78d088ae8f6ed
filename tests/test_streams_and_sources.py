import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators import bitmap, changelog, retrieval
from cairn.sources import catalog, changelog_source, csvio, messages, ordergen
from cairn.sources.keyed_table import KeyedTable
from cairn.streaming import sinks, windows

LOG = "_shard int, _lsn long, _event_type int, _ts_us long, id long, v string"


@pytest.fixture
def snapshots(spark):
    old = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string")
    new = spark.createDataFrame([(i, f"v{i}" if i % 3 else None) for i in range(5, 30)], "id long, v string")
    return old, new


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def log_of(old, new):
    return changelog.diff(old, new, ["id"], F.pmod("id", F.lit(3)).cast("int"), F.col("id") * 10)


def test_diff_and_replay_are_inverse(snapshots):
    old, new = snapshots
    assert rows(changelog.replay(old, log_of(old, new), ["id"])) == rows(new)
    kinds = {r[0]: r[1] for r in log_of(old, new).groupBy("_event_type").count().collect()}
    assert kinds == {changelog.DELETE: 5, changelog.BEFORE_UPDATE: 5, changelog.AFTER_UPDATE: 5, changelog.INSERT: 10}


def test_select_offsets_filters_projection(spark):
    log = spark.createDataFrame([(0, i, t, i * 10, i, v) for i, (t, v) in enumerate([(5, "a"), (3, "a"), (7, None), (2, None)])] + [(1, 9, 5, 5, 9, "z")], LOG)
    ids = lambda **k: sorted(r["_lsn"] for r in changelog.select(log, **k).collect())
    assert ids(offsets={0: 1}, start_us=0) == [2, 3] and ids(start_us=10) == [1, 2, 3] and ids(ignore_delete=True, ignore_before_update=True) == [0, 2, 9]
    assert ids(filters=[("v", "IS_NULL", None)], columns=["id"]) == [2, 3] and ids(filters=[("v", "NOT_EQUAL", "a")]) == [9]
    assert changelog.select(log, ["id"], [("v", "IS_NULL", None)]).columns == [*changelog.SYSTEM, "id"]
    for bad in (dict(columns=["zz"]), dict(filters=[("v", "LIKE", "a")])):
        with pytest.raises(ValueError):
            changelog.select(log, **bad)
    assert rows(changelog.latest(log)) == [(0, 3), (1, 9)]


def test_late_records_of_closed_partitions_are_dropped(spark):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    log = spark.createDataFrame([(0, 0, 5, 10_000_000, 1, "a"), (0, 1, 5, 75_000_000, 2, "b"), (0, 2, 5, 20_000_000, 3, "late"), (1, 0, 5, 20_000_000, 4, "a")], LOG)
    got = changelog.open_partitions(log, ts("1970-01-01 00:00:00"), F.when(F.col("_ts_us") < 60_000_000, ts("1970-01-01 00:01:00")).otherwise(ts("1970-01-01 00:02:00")), 10)
    assert [r["id"] for r in got.orderBy("id").collect()] == [1, 2, 4]


def test_stream_sink_equals_replay(spark, snapshots, tmp_path):
    old, new = snapshots
    changelog_source.write_changelog(log_of(old, new), str(tmp_path / "log"))
    table = KeyedTable(spark, str(tmp_path / "table"), ["id"], buckets=4)
    table.create(old)
    stream = changelog_source.subscribe(spark, str(tmp_path / "log"))
    sinks.upsert(stream, table, str(tmp_path / "cp"), ignore_delete=False).awaitTermination()
    assert rows(table.read()) == rows(new)
    batch = changelog_source.subscribe(spark, str(tmp_path / "log"), streaming=False)
    assert rows(batch.select(*log_of(old, new).columns)) == rows(log_of(old, new))


def test_keyed_table_loses_its_last_row(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=3)
    table.create(spark.createDataFrame([(1, "a")], "id long, v string"))
    table.merge(spark.createDataFrame([(1, 1, "delete", None)], "id long, _seq long, _op string, v string"))
    assert rows(table.read()) == []
    table.check_and_put(spark.createDataFrame([(1, 1, "b")], "id long, _seq long, v string"), "v", "greater")
    assert rows(table.get(spark.createDataFrame([(1,), (2,)], "id long"))) == [(1, "b"), (2, None)]


def test_window_uv_in_batch_and_stream(spark, tmp_path):
    t0 = dt.datetime(2021, 3, 29, 13, 30)
    events = spark.createDataFrame([(t0 + dt.timedelta(seconds=i % 40), i % 7 + 1, "p" if i % 2 else "q") for i in range(200)] + [(t0, None, "p")], "ts timestamp, uid int, prov string")
    batch = windows.window_uv(events, "ts", "uid", ["prov"], 10)
    exact = events.groupBy("prov", F.window("ts", "10 seconds").end.alias("window_end")).agg(F.count_distinct("uid").alias("uv"))
    assert rows(batch) == rows(exact)
    events.write.parquet(str(tmp_path / "events"))
    table = KeyedTable(spark, str(tmp_path / "uv"), ["prov", "window_end", "bucket"], buckets=2)
    made = windows.window_bitmaps(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")), "ts", "uid", ["prov"], 10)
    table.create(windows.window_bitmaps(events.limit(0), "ts", "uid", ["prov"], 10))
    sinks.upsert_rows(made, table, str(tmp_path / "cp"), "bucket").awaitTermination()
    assert rows(table.read().groupBy("prov", "window_end").agg(F.sum(F.bitmap_count("bitmap")).alias("uv"))) == rows(exact)


def test_bitmaps_over_buckets(spark):
    df = spark.createDataFrame([("g", i) for i in (1, 2, 32768, 32769, 70000, 70000, 1_000_000)] + [("h", None)], "g string, id int")
    made = bitmap.build(df, ["g"], "id")
    assert bitmap.to_array(made, ["g"]).first()["ids"] == [1, 2, 32768, 32769, 70000, 1_000_000] and bitmap.cardinality(made, ["g"]).first()["uv"] == 6
    assert {(r["g"], r["grouping_id"]): r["uv"] for r in bitmap.rollup(made, ["g"], cube=True).collect()} == {("g", 0): 6, (None, 1): 6}


def test_routing_to_many_tables(spark, tmp_path):
    targets = {n: KeyedTable(spark, str(tmp_path / n), ["id"], 2) for n in ("a", "b")}
    for t in targets.values():
        t.create(spark.createDataFrame([], "id long, name string"))
    batch = spark.createDataFrame([("a", 1, "x", None), ("b", 2, "y", None), ("a", 3, "z", "extra")], "tablename string, id long, name string, price string")
    assert sinks.route(batch, targets, extra_columns="drop")["a"].count() == 2
    with pytest.raises(Exception, match="lacks one of"):
        sinks.route(batch, targets)["a"].count()
    with pytest.raises(Exception, match="no table"):
        sinks.route(batch.withColumn("tablename", F.lit("zz")), targets, extra_columns="drop")["a"].count()


def test_messages(spark):
    shape = T.StructType.fromDDL("id long, name string")
    values = ['{"id": 1, "name": "a", "more": 2}', "not json", None, '{"id": "x"}']
    recs = spark.createDataFrame([(b"k", v.encode() if v else None, "t", 0, i, dt.datetime(2024, 1, 1 + i)) for i, v in enumerate(values)], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    got = messages.decode(recs, shape, meta={"offset": "at", "topic": "src"}).orderBy("at").collect()
    assert [r["_bad"] for r in got] == [False, True, True, True] and (got[0]["id"], got[0]["name"], got[0]["src"]) == (1, "a", "t")
    wrapped = recs.withColumn("value", F.lit('{"schema": {}, "payload": {"id": 5}}').cast("binary"))
    assert messages.decode(wrapped, shape, "struct_json").first()["id"] == 5
    assert messages.decode(recs, shape, "string", start=F.lit("2024-01-03").cast("timestamp")).count() == 2


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b', None, [1, 2], b"\x00\xff"), (2, "line\nbreak", 2.5, None, None), (3, "", 1e10, [], b"")], "id long, s string, f double, a array<int>, y binary")
    csvio.export_csv(df, str(tmp_path / "c"))
    assert rows(csvio.import_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)
    csvio.export_csv(df, str(tmp_path / "s"), key=["id"], shards=4, only=(0, 4))
    assert csvio.import_csv(spark, str(tmp_path / "s"), df.schema).count() == 3


def test_shipping(spark, tmp_path):
    catalog.export_database(spark, {"t1": spark.range(5)}, str(tmp_path / "db"), views={"v1": "SELECT max(id) AS m FROM t1"})
    assert catalog.import_database(spark, str(tmp_path / "db"))["t1"].count() == 5 and spark.sql("SELECT m FROM v1").first()[0] == 4
    assert catalog.privileges(spark.createDataFrame([("o", "u", "w"), ("o", "u", "r"), ("o", "u", "r")], "object string, grantee string, privilege string")).first()["privileges"] == "r,w"


def test_overwrite_and_catalog(spark):
    spark.sql("DROP TABLE IF EXISTS over_t")
    catalog.overwrite_table(spark.range(3), "over_t")
    catalog.overwrite_table(spark.range(7), "over_t")
    assert spark.table("over_t").count() == 7 and "over_t" in catalog.tables(spark) and "default" in catalog.namespaces(spark)


def test_order_generator(spark):
    df = ordergen.bounded(spark, 50)
    assert len(df.columns) == 11 and rows(df) == rows(ordergen.bounded(spark, 50)) and ordergen.stream(spark).isStreaming


def test_retrieval(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(20)], "vec_id long, embedding array<float>, label int")
    assert [r["vec_id"] for r in retrieval.nearest(v, [4.4, 1.0], 3).collect()] == [4, 5, 3]
    assert [(r["label"], r["vec_id"]) for r in retrieval.nearest_by(v, [4.4, 1.0], 1, "label").orderBy("label").collect()] == [(0, 4), (1, 5)]
    for metric in ("l2", "cosine", "inner"):
        got = retrieval.nearest_for(v.where("vec_id IN (3, 7)"), v, 4, metric=metric)
        for q in (3, 7):
            assert [r["vec_id"] for r in got.where(f"query_id = {q}").orderBy("rank").collect()] == [r["vec_id"] for r in retrieval.nearest(v, [float(q), 1.0], 4, metric=metric).collect()]
    docs = spark.createDataFrame([("g", 1, 900), ("g", 2, 1200), ("g", 3, 1000), ("g", 4, 100)], "g string, id long, n long")
    assert tuple(retrieval.pack(docs, ["g"], "id", "n", "id", 2000).first()) == ("g", 2000, [1, 3, 4])
    toks = spark.createDataFrame([([[1.0, 4.0], [3.0, 2.0]],)], "t array<array<float>>")
    pooled = {m: toks.select(retrieval.pool(F.col("t"), m)).first()[0] for m in ("mean", "max", "cls", "last", "weighted_mean")}
    assert pooled == {"mean": [2.0, 3.0], "max": [3.0, 4.0], "cls": [1.0, 4.0], "last": [3.0, 2.0], "weighted_mean": [7 / 3, 8 / 3]}
    words = spark.createDataFrame([(1, "cat cat the"), (2, "dog the the")], "id int, t string")
    assert {r["id"]: r["word"] for r in retrieval.keywords(words, "id", "t", 1).collect()} == {1: "cat", 2: "the"}


def test_keywords_shuffle_only_words_that_may_be_among_them(spark, monkeypatch):
    import math
    import random
    from collections import Counter

    rng = random.Random(2)
    rows = [(i % 70, " ".join(f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(rng.choice([0, 2, 30, 300])))) for i in range(80)] + [(None, "aa bb"), (None, "bb cc"), (99, None)]
    texts: dict = {}
    for i, t in rows:
        texts.setdefault(i, []).extend(w for w in (t or "").split() if len(w) > 1)
    df = Counter(w for ws in texts.values() for w in set(ws))
    want = {}
    for i, ws in texts.items():
        weights = sorted((-round(c * (math.log((len(rows) + 1) / (df[w] + 1)) + 1), 9), w) for w, c in Counter(ws).items())
        want |= {(i, r + 1): w for r, (_, w) in enumerate(weights[:5])}
    docs = spark.createDataFrame(rows, "id long, t string")
    for known in (0, 3, 40, 1000):
        monkeypatch.setattr(retrieval, "KNOWN_WORDS", known)
        assert {(r["id"], r["rank"]): r["word"] for r in retrieval.keywords(docs, "id", "t").collect()} == want
    listed = spark.createDataFrame([(1, ["of"] * 2 + ["rare", "odd", "the"]), (2, None), (3, [])], "id long, words array<string>")
    told = spark.createDataFrame([("of", 50), ("the", 90), ("rare", 2), ("odd", 1)], "word string, df long")
    assert {r["word"] for r in retrieval._able_words(listed, told, "id", 2, 100).collect()} == {"rare", "odd"}
