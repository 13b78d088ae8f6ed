"""Every registered query of the engine against its SQL, on the smallest data."""

import glob
import math
import os

import duckdb
import pytest

from cairn.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, DATA)
    got = df.collect()
    if name not in catalogue.ORACLES:
        assert df.columns
        return
    found = db.sql(catalogue.ORACLES[name])
    assert sorted(found.columns) == sorted(df.columns)
    at = [found.columns.index(c) for c in df.columns]
    assert sorted((tuple(map(plain, r)) for r in got), key=repr) == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.entry(spark).count() > 0


def test_stream_sink_equals_replay(spark):
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(catalogue.QUERIES["stream_upsert_sink"](spark, DATA)) == key(catalogue.QUERIES["cdc_replay"](spark, DATA))


def test_stream_sink_with_events_of_a_key_in_any_order(spark, monkeypatch, tmp_path):
    """Files of one write have no order, so all events of a key must lie in one of them."""
    from pyspark.sql import functions as F

    from cairn.plans import changes

    replayed = sorted(map(tuple, catalogue.QUERIES["cdc_replay"](spark, DATA).collect()))
    log = changes._change_log
    monkeypatch.setattr(changes, "_change_log", lambda s, d: log(s, d).repartitionByRange(4, F.col("_event_type").desc()))
    monkeypatch.setattr(changes, "work_dir", lambda s, name: str(tmp_path / name))
    assert sorted(map(tuple, catalogue.QUERIES["stream_upsert_sink"](spark, DATA).collect())) == replayed
    files = spark.read.parquet(str(tmp_path / "upsert" / "log")).select("o_orderkey", F.col("_metadata.file_path").alias("file")).distinct()
    assert files.count() == files.select("o_orderkey").distinct().count()
