"""Queries on mutations and change logs.

Fixture: the table is ``customer`` as (k, name, v, seg); its change log is ``orders``,
shifted so that some keys are new, in the order of o_orderkey.
"""

from pyspark.sql import functions as F

from cairn.functions import partitioning
from cairn.operators import changelog, mutate
from cairn.plans.registry import query, write_in_order
from cairn.session import table, work_dir
from cairn.sources import changelog_source
from cairn.sources.keyed_table import KeyedTable, overwrite_partition
from cairn.streaming import sinks
from cairn.streaming.lookups import lookup_stream, to_folder
from cairn.streaming.partitions import PartitionSubscription, heartbeats

_BASE = "base AS (SELECT c_custkey AS k, c_name AS name, c_acctbal AS v, c_mktsegment AS seg FROM customer)"
_CHG = """chg AS (SELECT o_custkey + 50 AS k, o_orderkey AS _seq, CASE WHEN o_orderpriority LIKE '1%' THEN 'delete' ELSE 'put' END AS op,
  o_orderpriority AS name, o_totalprice AS v, o_orderstatus AS seg,
  o_orderstatus IN ('O', 'P') AS s_name, o_orderstatus IN ('O', 'F') AS s_v, o_orderstatus = 'O' AS s_seg FROM orders)"""


def _base(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("seg"))


def _log(spark, d, deletes=False, partial=True):
    o = table(spark, d, "orders")
    status = F.col("o_orderstatus")
    sets = F.when(status == "O", F.array(F.lit("name"), F.lit("v"), F.lit("seg"))).when(status == "F", F.array(F.lit("v"))).otherwise(F.array(F.lit("name")))
    out = o.select(
        (F.col("o_custkey") + 50).alias("k"), F.col("o_orderkey").alias("_seq"), F.when(F.col("o_orderpriority").startswith("1"), "delete").otherwise("put").alias("_op"),
        F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("v"), status.alias("seg"), *([sets.alias("_set")] if partial else []))
    return out if deletes else out.drop("_op")


@query(f"""WITH {_BASE}, {_CHG}, last AS (SELECT k, arg_max(struct_pack(name := CASE WHEN s_name THEN name END, v := CASE WHEN s_v THEN v END, seg := CASE WHEN s_seg THEN seg END), _seq) AS r FROM chg GROUP BY k)
SELECT coalesce(l.k, b.k) AS k, CASE WHEN l.k IS NULL THEN b.name ELSE l.r.name END AS name, CASE WHEN l.k IS NULL THEN b.v ELSE l.r.v END AS v,
 CASE WHEN l.k IS NULL THEN b.seg ELSE l.r.seg END AS seg FROM base b FULL JOIN last l ON b.k = l.k""")
def upsert_replace(spark, d):
    return mutate.apply_mutations(_base(spark, d), _log(spark, d), ["k"], mutate.REPLACE)


@query(f"""WITH {_BASE}, {_CHG}, first AS (SELECT k, arg_min(struct_pack(name := CASE WHEN s_name THEN name END, v := CASE WHEN s_v THEN v END, seg := CASE WHEN s_seg THEN seg END), _seq) AS r FROM chg GROUP BY k)
SELECT coalesce(b.k, l.k) AS k, CASE WHEN b.k IS NULL THEN l.r.name ELSE b.name END AS name, CASE WHEN b.k IS NULL THEN l.r.v ELSE b.v END AS v,
 CASE WHEN b.k IS NULL THEN l.r.seg ELSE b.seg END AS seg FROM base b FULL JOIN first l ON b.k = l.k""")
def upsert_ignore(spark, d):
    return mutate.apply_mutations(_base(spark, d), _log(spark, d), ["k"], mutate.IGNORE)


@query(f"""WITH {_BASE}, {_CHG}, f AS (SELECT k, arg_max(name, _seq) FILTER (WHERE s_name) AS name, arg_max(v, _seq) FILTER (WHERE s_v) AS v, arg_max(seg, _seq) FILTER (WHERE s_seg) AS seg FROM chg GROUP BY k)
SELECT coalesce(b.k, f.k) AS k, coalesce(f.name, b.name) AS name, coalesce(f.v, b.v) AS v, coalesce(f.seg, b.seg) AS seg FROM base b FULL JOIN f ON b.k = f.k""")
def upsert_update(spark, d):
    return mutate.apply_mutations(_base(spark, d), _log(spark, d), ["k"], mutate.UPDATE)


@query(f"""WITH {_BASE}, {_CHG}, f AS (SELECT k, arg_max(name, _seq) FILTER (WHERE s_name) AS name, arg_min(struct_pack(v := CASE WHEN s_v THEN v END), _seq).v AS v, arg_max(seg, _seq) FILTER (WHERE s_seg) AS seg FROM chg GROUP BY k)
SELECT coalesce(b.k, f.k) AS k, coalesce(f.name, b.name) AS name, CASE WHEN b.k IS NULL THEN f.v ELSE b.v END AS v, coalesce(f.seg, b.seg) AS seg FROM base b FULL JOIN f ON b.k = f.k""")
def upsert_insert_only(spark, d):
    return mutate.apply_mutations(_base(spark, d), _log(spark, d), ["k"], mutate.UPDATE, insert_only=["v"])


@query(f"""WITH {_BASE}, {_CHG}, f AS (SELECT k, arg_max(name, _seq) FILTER (WHERE s_name) AS name, arg_max(v, _seq) FILTER (WHERE s_v) AS v, arg_max(seg, _seq) AS seg FROM chg GROUP BY k)
SELECT coalesce(b.k, f.k) AS k, coalesce(f.name, b.name) AS name, coalesce(f.v, b.v) AS v, coalesce(f.seg, b.seg) AS seg FROM base b FULL JOIN f ON b.k = f.k""")
def upsert_ignore_null(spark, d):
    log = _log(spark, d, partial=False).withColumns({"name": F.when(F.col("seg").isin("O", "P"), F.col("name")), "v": F.when(F.col("seg").isin("O", "F"), F.col("v"))})
    return mutate.apply_mutations(_base(spark, d), log, ["k"], mutate.UPDATE, ignore_null=True)


@query(f"""WITH {_BASE} SELECT * FROM base WHERE k NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def delete_by_key(spark, d):
    keys = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("k"))
    return mutate.delete_keys(_base(spark, d), keys, ["k"])


@query(f"""WITH {_BASE}, {_CHG}, dl AS (SELECT k, max(_seq) AS del FROM chg WHERE op = 'delete' GROUP BY k),
p AS (SELECT chg.* FROM chg LEFT JOIN dl ON chg.k = dl.k WHERE op = 'put' AND (del IS NULL OR _seq > del)),
f AS (SELECT k, arg_max(name, _seq) FILTER (WHERE s_name) AS name, arg_max(v, _seq) FILTER (WHERE s_v) AS v, arg_max(seg, _seq) FILTER (WHERE s_seg) AS seg FROM p GROUP BY k),
live AS (SELECT * FROM base WHERE k NOT IN (SELECT k FROM dl))
SELECT coalesce(b.k, f.k) AS k, coalesce(f.name, b.name) AS name, coalesce(f.v, b.v) AS v, coalesce(f.seg, b.seg) AS seg FROM live b FULL JOIN f ON b.k = f.k""")
def mutation_log_replay(spark, d):
    return mutate.apply_mutations(_base(spark, d), _log(spark, d, deletes=True), ["k"], mutate.UPDATE)


_BEST = "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC, _seq) AS rn FROM chg) WHERE rn = 1)"


@query(f"""WITH {_BASE}, {_CHG}, {_BEST}
SELECT coalesce(b.k, t.k) AS k, CASE WHEN b.k IS NULL OR t.v > b.v THEN t.name ELSE b.name END AS name, CASE WHEN b.k IS NULL OR t.v > b.v THEN t.v ELSE b.v END AS v,
 CASE WHEN b.k IS NULL OR t.v > b.v THEN t.seg ELSE b.seg END AS seg FROM base b FULL JOIN best t ON b.k = t.k""")
def check_and_put_gt(spark, d):
    return mutate.check_and_put(_base(spark, d), _log(spark, d, partial=False), ["k"], "v", "greater")


@query(f"""WITH {_BASE.replace('c_acctbal AS v', "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS v")}, {_CHG}, {_BEST}
SELECT coalesce(b.k, t.k) AS k, CASE WHEN b.k IS NULL OR t.v > coalesce(b.v, 300000) THEN t.name ELSE b.name END AS name, CASE WHEN b.k IS NULL OR t.v > coalesce(b.v, 300000) THEN t.v ELSE b.v END AS v,
 CASE WHEN b.k IS NULL OR t.v > coalesce(b.v, 300000) THEN t.seg ELSE b.seg END AS seg FROM base b FULL JOIN best t ON b.k = t.k""")
def check_and_put_nullas(spark, d):
    base = _base(spark, d).withColumn("v", F.when(F.col("seg") != "BUILDING", F.col("v")))
    return mutate.check_and_put(base, _log(spark, d, partial=False), ["k"], "v", "greater", null_as="300000")


@query(f"""WITH {_BASE}, {_CHG} SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM chg WHERE chg.k = b.k AND chg.v / 100 < b.v)""")
def check_and_delete(spark, d):
    log = _log(spark, d, partial=False).withColumns({"_op": F.lit("delete"), "v": F.col("v") / 100})
    return mutate.check_and_put(_base(spark, d), log, ["k"], "v", "less")


@query("""WITH base AS (SELECT c_custkey AS k, c_acctbal AS v, TIMESTAMP '1995-06-01' AS ts FROM customer),
chg AS (SELECT o_custkey + 50 AS k, o_orderkey AS _seq, o_totalprice AS v, o_orderdate AS ts FROM orders),
run AS (SELECT chg.*, b.ts AS b_ts, max(chg.ts) OVER (PARTITION BY chg.k ORDER BY _seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM chg LEFT JOIN base b ON b.k = chg.k),
f AS (SELECT k, sum(v) AS v, max(ts) AS ts FROM run WHERE (b_ts IS NULL OR ts > b_ts) AND (m IS NULL OR ts > m) GROUP BY k)
SELECT coalesce(b.k, f.k) AS k, round(coalesce(b.v, 0) + coalesce(f.v, 0), 2) AS v, greatest(coalesce(b.ts, f.ts), coalesce(f.ts, b.ts)) AS ts FROM base b FULL JOIN f ON b.k = f.k""")
def expression_upsert(spark, d):
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.to_timestamp_ntz(F.lit("1995-06-01 00:00:00")).alias("ts"))
    log = table(spark, d, "orders").select((F.col("o_custkey") + 50).alias("k"), F.col("o_orderkey").alias("_seq"), F.col("o_totalprice").alias("v"), F.col("o_orderdate").alias("ts"))
    return mutate.expression_upsert(base, log, ["k"], {"v": "old.v + excluded.v", "ts": "excluded.ts"}, "excluded.ts > old.ts").withColumn("v", F.round("v", 2))


@query("""SELECT l_partkey, max(o) AS last_order, arg_max(l_suppkey, o) AS l_suppkey FROM (SELECT *, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey AS o FROM lineitem) GROUP BY l_partkey""")
def bulk_keep_last(spark, d):
    rows = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", (F.col("l_orderkey") * 1000000 + F.col("l_linenumber") * 100000 + F.col("l_suppkey")).alias("last_order"))
    return mutate.keep_last(rows, ["l_partkey"], "last_order").select("l_partkey", "last_order", "l_suppkey")


def _snapshots(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    kept = old.where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return old, kept.unionByName(old.where("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey") - 1))


def _change_log(spark, d):
    old, new = _snapshots(spark, d)
    return changelog.diff(old, new, ["o_orderkey"], F.pmod("o_custkey", F.lit(4)).cast("int"), F.abs("o_orderkey") * 1_000_000)


_DIFF = """e AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS _event_type FROM orders WHERE o_orderstatus IN ('P', 'F')
 UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderstatus, 7 FROM orders WHERE o_orderstatus = 'F'
 UNION ALL SELECT -o_orderkey - 1, o_custkey, o_totalprice, o_orderstatus, 5 FROM orders WHERE o_orderstatus = 'P'),
log AS (SELECT CAST(o_custkey % 4 AS INTEGER) AS _shard, row_number() OVER (PARTITION BY o_custkey % 4 ORDER BY o_orderkey, _event_type) AS _lsn, _event_type,
 abs(o_orderkey) * 1000000 AS _ts_us, o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM e)"""


@query(f"WITH {_DIFF} SELECT * FROM log")
def cdc_diff(spark, d):
    return _change_log(spark, d)


_REPLAYED = """SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders"""


@query(_REPLAYED)
def cdc_replay(spark, d):
    return changelog.replay(_snapshots(spark, d)[0], _change_log(spark, d), ["o_orderkey"])


@query(f"WITH {_DIFF} SELECT _shard, _lsn, _event_type, _ts_us, o_orderkey FROM log WHERE _event_type NOT IN (2, 3) AND o_totalprice >= 100000 AND o_orderstatus <> 'O' AND _ts_us >= 1000000000")
def cdc_filter_project(spark, d):
    return changelog.select(_change_log(spark, d), ["o_orderkey"], [("o_totalprice", "GREATER_EQUAL", 100000), ("o_orderstatus", "NOT_EQUAL", "O")], 1_000_000_000, ignore_delete=True, ignore_before_update=True)


@query(f"WITH {_DIFF} SELECT _shard, max(_lsn) AS _lsn FROM log GROUP BY _shard")
def cdc_latest_lsn(spark, d):
    return changelog.latest(_change_log(spark, d))


@query(f"WITH {_DIFF} SELECT _shard, count(*) AS n FROM log WHERE (_shard = 1 AND o_orderstatus = 'F') OR (_shard = 2 AND o_orderstatus = 'P') GROUP BY _shard")
def cdc_static_partitions(spark, d):
    return changelog.in_partitions(_change_log(spark, d), ["_shard", "o_orderstatus"], [(1, "F"), (2, "P")]).groupBy("_shard").agg(F.count("*").alias("n"))


@query("""WITH log AS (SELECT CAST(user_id % 4 AS INTEGER) AS _shard, event_id AS _lsn, epoch_us(ts) AS _ts_us, event_id, date_trunc('day', ts) AS day FROM events),
seen AS (SELECT *, max(_ts_us) OVER (PARTITION BY _shard ORDER BY _lsn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM log)
SELECT event_id FROM seen WHERE m < epoch_us(day + INTERVAL 1 DAY) + 3600000000""")
def cdc_dynamic_partition(spark, d):
    e = table(spark, d, "events")
    log = e.select(F.pmod("user_id", F.lit(4)).cast("int").alias("_shard"), F.col("event_id").alias("_lsn"), F.lit(changelog.INSERT).alias("_event_type"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_ts_us"), "event_id", "ts")
    day = partitioning.suffix(F.col("ts"), "DAY")
    return changelog.open_partitions(log, partitioning.start(day, "DAY"), partitioning.stop(day, "DAY"), 3600).select("event_id")


def _in_files(log, key, path, batches):
    """Write a log for a stream of files, a multiple of ``batches``, and tell how many a batch has.

    Files of one write come in any order, so all events of a key lie in one of them.
    """
    each = -(-log.sparkSession.sparkContext.defaultParallelism // batches)
    log.repartition(batches * each, *key).write.parquet(path)
    return each


@query(_REPLAYED)
def stream_upsert_sink(spark, d):
    """A change stream merged into a keyed table, read back."""
    folder = work_dir(spark, "upsert")
    each = _in_files(_change_log(spark, d), ["o_orderkey"], f"{folder}/log", 4)
    target = KeyedTable(spark, f"{folder}/table", ["o_orderkey"], buckets=8)
    target.create(_snapshots(spark, d)[0])
    schema = spark.read.parquet(f"{folder}/log").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", each).parquet(f"{folder}/log")
    sinks.upsert(stream, target, f"{folder}/checkpoint", ignore_delete=False).awaitTermination()
    return target.read()


@query(f"WITH {_DIFF} SELECT _shard, _lsn, _event_type, _ts_us, o_orderkey, o_custkey FROM log WHERE _shard <> 1 OR _lsn > 100")
def cdc_subscribe(spark, d):
    """A stored change log read from the record after an offset."""
    path = f"{work_dir(spark, 'log')}"
    changelog_source.write_changelog(_change_log(spark, d), path)
    return changelog_source.subscribe(spark, path, {1: 100}, streaming=False).select("_shard", "_lsn", "_event_type", "_ts_us", "o_orderkey", "o_custkey")


@query("""WITH log AS (SELECT CAST(user_id % 4 AS INTEGER) AS _shard, epoch_us(ts) AS t, date_trunc('day', ts) + INTERVAL 1 DAY AS e FROM events),
reached AS (SELECT min(m) AS m FROM (SELECT max(t) AS m FROM log GROUP BY _shard))
SELECT DISTINCT CAST(e AS DATE) AS ended FROM log, reached WHERE m >= epoch_us(e) + 3600000000""")
def cdc_closed_partitions(spark, d):
    """Day partitions that all shards have closed."""
    log = table(spark, d, "events").select(F.pmod("user_id", F.lit(4)).cast("int").alias("_shard"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_ts_us"), "ts")
    ends = partitioning.stop(partitioning.suffix(F.col("ts"), "DAY"), "DAY")
    return changelog.closed_partitions(log, ends, 3600).select(F.col("partition_end").cast("date").alias("ended"))


@query(f"""WITH {_DIFF} SELECT _shard, max(_lsn) AS last, count(*) AS n, sum(o_orderkey) AS keys, count(o_orderstatus) FILTER (WHERE _lsn % 2 = 1) AS marked FROM log WHERE _shard <> 1 OR _lsn > 100 GROUP BY _shard""")
def changelog_follow(spark, d):
    """A stored log, appended in two commits of which the second has a column more, followed from an offset into a table."""
    folder = work_dir(spark, "follow")
    log = _change_log(spark, d).drop("o_totalprice")
    changelog_source.write_changelog(log.where("_lsn % 2 = 0").drop("o_orderstatus"), f"{folder}/log")
    changelog_source.write_changelog(log.where("_lsn % 2 = 1"), f"{folder}/log")
    target = KeyedTable(spark, f"{folder}/table", ["shard", "lsn"], 4)
    target.create(log.select(F.col("_shard").alias("shard"), F.col("_lsn").alias("lsn"), "o_orderkey", "o_custkey").limit(0))

    def step(events, batch_id):
        target.merge(events.drop("_event_type", "_ts_us").withColumnsRenamed({"_shard": "shard", "_lsn": "lsn"}).withColumn("_seq", F.lit(batch_id)), evolve=True, once=("follow", batch_id))

    changelog_source.follow(spark, f"{folder}/log", step, f"{folder}/checkpoint", {1: 100}, commits_per_batch=1).awaitTermination()
    return target.read().groupBy(F.col("shard").alias("_shard")).agg(
        F.max("lsn").alias("last"), F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.count("o_orderstatus").alias("marked"))


@query("""SELECT p_partkey * 7 AS o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM part LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = p_partkey * 7""")
def keyed_get(spark, d):
    """Gets from a stored keyed table after a merge of puts and deletes; only the buckets of the keys are read."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    target = KeyedTable(spark, work_dir(spark, "get"), ["o_orderkey"])
    target.create(o)
    op = F.when(F.col("o_orderstatus") == "F", "put").otherwise("delete")
    target.merge(o.where("o_orderstatus IN ('F', 'P')").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "_op": op, "_seq": F.lit(1)}))
    keys = table(spark, d, "part").select((F.col("p_partkey") * 7).alias("o_orderkey"))
    return target.get(keys, ["o_custkey", "o_totalprice"])


@query("""SELECT o_orderkey, o_totalprice, o_orderstatus = 'O' AS again FROM orders""")
def keyed_growth(spark, d):
    """A table that grows from nothing by merges, its buckets split on the way, read back."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.lit(1).alias("_seq"))
    target = KeyedTable(spark, work_dir(spark, "growth"), ["o_orderkey"], buckets=1, bucket_rows=5000)
    target.create(o.select("o_orderkey", "o_totalprice", F.lit(False).alias("again")).limit(0))
    for status, again in (("O", False), ("F", False), ("P", False), ("O", True)):
        target.merge(o.where(F.col("o_orderstatus") == status).withColumn("again", F.lit(again)).drop("o_orderstatus"))
    return target.read()


@query("""SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_totalprice, o_orderstatus FROM orders""")
def stream_held_deletes(spark, d):
    """A stream that ends before the updates' after-images: the rows they change are still there, as they were."""
    folder = work_dir(spark, "held")
    _change_log(spark, d).where("_event_type <> 7").coalesce(2).write.parquet(f"{folder}/log")
    target = KeyedTable(spark, f"{folder}/table", ["o_orderkey"], buckets=8)
    target.create(_snapshots(spark, d)[0])
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/log").schema).parquet(f"{folder}/log")
    sinks.upsert(stream, target, f"{folder}/checkpoint", ignore_delete=False).awaitTermination()
    return target.read().select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("""WITH log AS (SELECT CAST(user_id % 4 AS INTEGER) AS _shard, event_id AS _lsn, epoch_us(ts) AS _ts_us, date_trunc('day', ts) AS day FROM events),
seen AS (SELECT *, max(_ts_us) OVER (PARTITION BY _shard ORDER BY _lsn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM log),
kept AS (SELECT day, count(*) AS n, sum(_lsn) AS s FROM seen WHERE m < epoch_us(day + INTERVAL 1 DAY) + 3600000000 GROUP BY day),
low AS (SELECT min(m) AS low FROM (SELECT max(_ts_us) AS m FROM log GROUP BY _shard)),
days AS (SELECT unnest(generate_series((SELECT min(day) FROM log), (SELECT max(day) FROM log), INTERVAL 1 DAY)) AS day)
SELECT strftime(days.day, '%Y%m%d') AS partition, coalesce(n, 0) AS n, CAST(coalesce(s, 0) AS BIGINT) AS ids, low >= epoch_us(days.day + INTERVAL 1 DAY) + 3600000000 AS closed
FROM days LEFT JOIN kept ON kept.day = days.day, low""")
def stream_dynamic_partitions(spark, d):
    """Day partitions of a stream of four shards, and a fifth without records that heartbeats move on: rows kept, and what has closed."""
    folder = work_dir(spark, "dynamic")
    e = table(spark, d, "events")
    log = e.select(
        F.pmod("user_id", F.lit(4)).cast("int").alias("_shard"), F.col("event_id").alias("_lsn"), F.lit(changelog.INSERT).alias("_event_type"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_ts_us"))
    most = log.agg(F.max("_ts_us")).first()[0]
    write_in_order(log, F.col("_lsn"), 3, f"{folder}/log")
    heartbeats(log, {4: most}).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    followed = PartitionSubscription(spark, f"{folder}/out", "DAY", range(5), 3600)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/log")
    followed.start(stream, f"{folder}/checkpoint").awaitTermination()
    kept = followed.rows(log).groupBy(F.col("_partition").cast("string").alias("partition")).agg(F.count("*").alias("n"), F.sum("_lsn").alias("ids"))
    told = followed.children().groupBy("partition").agg(F.max(F.col("event") == "close").alias("closed"))
    return told.join(kept, "partition", "left").select("partition", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("ids", F.lit(0)).alias("ids"), "closed")


@query("""WITH dim AS (SELECT c_custkey AS uid, c_custkey AS uid_int FROM customer),
new AS (SELECT DISTINCT o_orderkey AS uid FROM orders WHERE o_orderkey NOT IN (SELECT uid FROM dim)),
grown AS (SELECT uid, uid_int FROM dim UNION ALL
  SELECT uid, (SELECT max(uid_int) FROM dim) + row_number() OVER (ORDER BY uid) FROM new)
SELECT o_orderkey, uid_int FROM orders JOIN grown ON o_orderkey = uid""")
def stream_lookup_insert(spark, d):
    """A stream in three micro-batches looked up in a keyed table, to which the keys that it lacks are added on the way."""
    folder = work_dir(spark, "lookup")
    o = table(spark, d, "orders").select("o_orderkey")
    write_in_order(o, F.col("o_orderkey"), 3, f"{folder}/orders")
    dim = KeyedTable(spark, f"{folder}/dim", ["uid"], 8)
    dim.create(table(spark, d, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_custkey").alias("uid_int")))
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/orders")
    lookup_stream(stream, dim, {"o_orderkey": "uid"}, to_folder(f"{folder}/out"), f"{folder}/checkpoint", serial="uid_int").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("o_orderkey", "uid_int")


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0""")
def overwrite_one_partition(spark, d):
    """One partition of a stored table replaced, the others left as they are."""
    path = work_dir(spark, "partitions")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    o.write.partitionBy("o_orderstatus").parquet(path)
    overwrite_partition(o.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(-1.0)), path, "o_orderstatus")
    return spark.read.schema(o.schema).parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")
