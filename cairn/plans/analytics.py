"""Queries on bitmaps, windows and general SQL."""

from pyspark.sql import functions as F

from cairn.operators import bitmap, metrics
from cairn.plans.registry import query
from cairn.session import load_tables, table
from cairn.streaming import windows


def _bitmaps(spark, d):
    return bitmap.build(table(spark, d, "events").withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id")


@query("SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL")
def bitmap_uv_day(spark, d):
    return bitmap.cardinality(_bitmaps(spark, d), ["event_type", "day"])


@query("SELECT event_type, CAST(ts AS DATE) AS day, CAST(grouping_id(event_type, CAST(ts AS DATE)) AS BIGINT) AS grouping_id, count(DISTINCT user_id) AS uv FROM events GROUP BY ROLLUP (event_type, CAST(ts AS DATE))")
def bitmap_uv_rollup(spark, d):
    return bitmap.rollup(_bitmaps(spark, d), ["event_type", "day"])


@query("SELECT event_type, list_sort(list(DISTINCT user_id)) AS ids FROM events WHERE user_id IS NOT NULL GROUP BY event_type")
def bitmap_to_array(spark, d):
    return bitmap.to_array(bitmap.merge(_bitmaps(spark, d), ["event_type"]), ["event_type"])


@query("""WITH a AS (SELECT l_returnflag AS flag, l_orderkey * 524287001 AS id FROM lineitem), b AS (SELECT o_orderkey * 524287001 AS id FROM orders WHERE o_orderstatus = 'F')
SELECT flag, count(DISTINCT id) AS uv, count(DISTINCT CASE WHEN id IN (SELECT id FROM b) THEN id END) AS also FROM a GROUP BY flag""")
def bitmap_sparse_ids(spark, d):
    """Ids far apart: distinct ones of each group, and how many of them a second set has."""
    spread = lambda c: (F.col(c) * 524_287_001).alias("id")
    a = bitmap.build(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), spread("l_orderkey")), ["flag"], "id")
    b = bitmap.build(table(spark, d, "orders").where("o_orderstatus = 'F'").select(spread("o_orderkey")), [], "id")
    also = bitmap.cardinality(bitmap.intersect(a, b, []), ["flag"], "also")
    return bitmap.cardinality(a, ["flag"]).join(also, "flag", "left").select("flag", "uv", F.coalesce("also", F.lit(0)).alias("also"))


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL")
def uv_tumbling(spark, d):
    return windows.window_uv(table(spark, d, "events"), "ts", "user_id", ["event_type"], 3600)


@query("SELECT event_type, count(value) AS count, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.99), 6) AS p99, round(quantile_cont(value, 0.999), 6) AS p999 FROM events GROUP BY event_type")
def latency_metrics(spark, d):
    found = metrics.latency(table(spark, d, "events"), "value", ["event_type"], exact=True)
    return found.select("event_type", "count", *[F.round(c, 6).alias(c) for c in ("mean", "p99", "p999")])


_Q1 = """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(round(l_quantity) AS BIGINT)) AS quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS price
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus"""
_Q3 = """SELECT n_name, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS price FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE o_orderdate >= TIMESTAMP '1994-01-01' GROUP BY n_name"""
_RANK = """SELECT o_custkey, o_orderkey, rn FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rn FROM orders) t WHERE rn <= 3"""
_SET = """SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000"""
_ANTI = """SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)"""
_CUBE = """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)"""


def _sql(name, text):
    def run(spark, d):
        load_tables(spark, d, register=True)
        return spark.sql(text)

    run.__name__ = name
    query(text)(run)


for _name, _text in (("sql_group", _Q1), ("sql_star_join", _Q3), ("sql_window_rank", _RANK), ("sql_except", _SET), ("sql_anti_join", _ANTI), ("sql_cube", _CUBE)):
    _sql(_name, _text)
