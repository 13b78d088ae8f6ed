"""Queries on reads: gets, scans, predicates, lookups, SQL sources."""

from pyspark.sql import functions as F

from cairn.operators import lookup, scan
from cairn.plans.registry import query
from cairn.session import load_tables, table, work_dir
from cairn.sources.clustered import ClusteredTable


@query("""SELECT k AS o_orderkey, o_custkey, o_totalprice FROM (VALUES (CAST(1 AS BIGINT)), (7), (7), (500), (-1)) v(k) LEFT JOIN orders ON o_orderkey = k""")
def get_point(spark, d):
    return scan.get_values(spark, table(spark, d, "orders"), ["o_orderkey"], [(1,), (7,), (7,), (500,), (-1,)], ["o_custkey", "o_totalprice"])


@query("""SELECT p_partkey * 7 AS o_orderkey, o_custkey, o_orderstatus FROM part LEFT JOIN orders ON o_orderkey = p_partkey * 7""")
def get_batch_left(spark, d):
    keys = table(spark, d, "part").select((F.col("p_partkey") * 7).alias("o_orderkey"))
    return scan.get(table(spark, d, "orders"), keys, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)""")
def get_members(spark, d):
    keys = table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return scan.members(table(spark, d, "orders"), keys, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("""SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1""")
def scan_eq(spark, d):
    return scan.scan(table(spark, d, "lineitem"), equal={"l_returnflag": "R", "l_linenumber": 1}, columns=["l_quantity", "l_orderkey", "l_partkey"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-07-01' ORDER BY o_orderkey""")
def scan_range_pk(spark, d):
    """Flagship: filtered, projected, key-ordered."""
    span = (F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")), F.to_timestamp_ntz(F.lit("1996-07-01 00:00:00")))
    return scan.scan(table(spark, d, "orders"), {"o_orderstatus": "O"}, {"o_orderdate": span}, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"], ["o_orderkey"])


@query("""SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND value < 50""")
def scan_open_range(spark, d):
    return scan.scan(table(spark, d, "events"), {"event_type": "click"}, {"value": (None, 50.0)}, ["event_id", "user_id", "value"])


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey = 33 ORDER BY l_orderkey, l_linenumber""")
def scan_prefix(spark, d):
    return scan.scan(table(spark, d, "lineitem"), {"l_orderkey": 33}, columns=["l_orderkey", "l_linenumber", "l_suppkey"], sort=["l_orderkey", "l_linenumber"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_quantity < 3
ORDER BY l_shipdate NULLS LAST, l_orderkey, l_linenumber, l_partkey""")
def scan_cluster_sort(spark, d):
    return scan.scan(table(spark, d, "lineitem"), between={"l_quantity": (None, 3)}, columns=["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"], sort=["l_shipdate:desc", "l_orderkey", "l_linenumber", "l_partkey"])


@query("""SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate NULLS LAST, o_orderkey LIMIT 100""")
def scan_limit(spark, d):
    return scan.scan(table(spark, d, "orders"), columns=["o_orderkey", "o_orderdate"], sort=["o_orderdate", "o_orderkey"], limit=100)


@query("""SELECT event_id FROM events WHERE NOT (value > 10 AND event_type <> 'view') AND user_id IS NOT NULL
AND (event_type = 'click' OR event_type = 'view' OR value <= 1) AND props IS NOT NULL""")
def predicate_mix(spark, d):
    e = table(spark, d, "events")
    kind = F.col("event_type")
    return e.where(~((F.col("value") > 10) & (kind != "view")) & F.col("user_id").isNotNull() & ((kind == "click") | (kind == "view") | (F.col("value") <= 1)) & F.col("props").isNotNull()).select("event_id")


@query("""SELECT o_orderstatus, count(*) AS n, sum(CAST(round(l_quantity) AS BIGINT)) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderstatus""")
def query_source_join(spark, d):
    load_tables(spark, d, register=True)
    return scan.query(spark, "SELECT o_orderstatus, count(*) AS n, sum(CAST(round(l_quantity) AS BIGINT)) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderstatus")


@query("""SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""")
def lookup_pk(spark, d):
    return lookup.lookup(table(spark, d, "events").select("event_id", "user_id"), table(spark, d, "customer"), {"user_id": "c_custkey"}, ["c_name", "c_mktsegment"])


@query("""SELECT n_nationkey, n_name, s_suppkey FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey""")
def lookup_one_to_many(spark, d):
    return lookup.lookup_many(table(spark, d, "nation").select("n_nationkey", "n_name"), table(spark, d, "supplier"), {"n_nationkey": "s_nationkey"}, ["s_suppkey"])


@query("""SELECT s_suppkey, s_nationkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey AND c_mktsegment = 'BUILDING'""")
def lookup_partitioned(spark, d):
    facts = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.lit("BUILDING").alias("segment"))
    return lookup.lookup_many(facts, table(spark, d, "customer"), {"s_nationkey": "c_nationkey", "segment": "c_mktsegment"}, ["c_custkey"], how="inner").drop("segment")


@query("""WITH dim AS (SELECT c_custkey AS uid, c_custkey AS uid_int FROM customer),
new AS (SELECT DISTINCT o_orderkey AS uid FROM orders WHERE o_orderkey NOT IN (SELECT uid FROM dim)),
grown AS (SELECT uid, uid_int FROM dim UNION ALL
  SELECT uid, (SELECT max(uid_int) FROM dim) + row_number() OVER (ORDER BY uid) FROM new)
SELECT o_orderkey, uid_int FROM orders JOIN grown ON o_orderkey = uid""")
def lookup_insert_if_missing(spark, d):
    dim = table(spark, d, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_custkey").alias("uid_int"))
    return lookup.lookup_or_insert(table(spark, d, "orders").select("o_orderkey"), dim, {"o_orderkey": "uid"}, "uid_int")[0]


def _clustered(spark, d, name, key, rows):
    return ClusteredTable.write(table(spark, d, name), work_dir(spark, "clustered"), key, rows)


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey >= 33 AND l_orderkey < 70 AND l_linenumber = 1 ORDER BY l_orderkey, l_linenumber""")
def clustered_prefix(spark, d):
    """A range and an equal value of the clustering key, from a table laid out by it."""
    return _clustered(spark, d, "lineitem", ["l_orderkey", "l_linenumber"], 5000).scan({"l_linenumber": 1}, {"l_orderkey": (33, 70)}, ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate NULLS LAST, o_orderkey LIMIT 100""")
def clustered_first(spark, d):
    """The first rows in clustering order that meet a condition; ranges are read until there are enough."""
    return _clustered(spark, d, "orders", ["o_orderdate:desc", "o_orderkey"], 1000).scan({"o_orderstatus": "P"}, columns=["o_orderkey", "o_orderdate"], limit=100)
