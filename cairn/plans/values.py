"""Queries on value conversion, sharding, partitioning and import or export."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import convert, partitioning, sharding, text
from cairn.plans.registry import query, write_in_order
from cairn.schema import ColumnDef, TableDef, widen
from cairn.session import table, work_dir
from cairn.sources import catalog, csvio, loader, messages
from cairn.sources.keyed_table import KeyedTable
from cairn.streaming import early, sinks, windows


def _hashed(source, columns, texts):
    """SQL of a CTE ``h``: the columns and the low 16 bits of the hash of texts, in integers of 32 bits."""
    full = 4294967295
    mixed = f"list_transform(list_transform(list_transform({{}}, lambda k: (k * 3432918353) & {full}), lambda k: ((k << 15) | (k >> 17)) & {full}), lambda k: (k * 461845907) & {full})"
    byte = lambda t, at, j: f"CAST(ascii(substr({t}, {at} + {j + 1}, 1)) AS UBIGINT) * {256 ** j}"
    out, steps = [], []
    for i, t in enumerate(texts):
        blocks = f"list_transform(range(0, length({t}) // 4), lambda i: {' + '.join(byte(t, '4 * i', j) for j in range(4))})"
        rest = " + ".join(f"CASE WHEN length({t}) % 4 > {j} THEN {byte(t, f'length({t}) // 4 * 4', j)} ELSE CAST(0 AS UBIGINT) END" for j in range(3))
        steps.append(f"list_reduce(list_prepend(CAST(104729 AS UBIGINT), {mixed.format(blocks)}), lambda h, k: ((((xor(h, k) << 13) | (xor(h, k) >> 19)) & {full}) * 5 + 3864292196) & {full}) AS a{i}, {mixed.format(f'[{rest}]')}[1] AS r{i}, CAST(length({t}) AS UBIGINT) AS n{i}")
        out.append(i)
    each = lambda f: ", ".join(f(i) for i in out)
    cols = ", ".join(columns)
    return f"""h0 AS (SELECT {cols}, {', '.join(steps)} FROM {source}), h1 AS (SELECT {cols}, {each(lambda i: f'xor(xor(a{i}, r{i}), n{i}) AS h{i}')} FROM h0),
h2 AS (SELECT {cols}, {each(lambda i: f'(xor(h{i}, h{i} >> 16) * 2246822507) & {full} AS h{i}')} FROM h1), h3 AS (SELECT {cols}, {each(lambda i: f'(xor(h{i}, h{i} >> 13) * 3266489909) & {full} AS h{i}')} FROM h2),
h AS (SELECT {cols}, CAST({reduce(lambda a, b: f'xor({a}, {b})', [f'xor(h{i}, h{i} >> 16)' for i in out])} AS BIGINT) & 65535 AS place FROM h3)"""


_SHARD = "CAST(CASE WHEN place < 26224 THEN place // 1639 ELSE 16 + (place - 26224) // 1638 END AS INTEGER)"
_LINES = _hashed("(SELECT CAST(l_orderkey AS VARCHAR) AS t, CAST(l_linenumber AS VARCHAR) AS u FROM lineitem)", ["t"], ["t", "u"])


@query(f"""WITH {_hashed("(SELECT *, CAST(o_orderkey AS VARCHAR) AS t FROM orders)", ["o_orderkey", "o_custkey"], ["t"])}
SELECT o_orderkey, o_custkey, {_SHARD} AS _shard FROM h""")
def shard_assign(spark, d):
    return sharding.with_shard(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 40)


@query(f"WITH {_LINES} SELECT {_SHARD} AS _shard, count(*) AS n FROM h GROUP BY 1")
def shard_counts(spark, d):
    return sharding.with_shard(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 40).groupBy("_shard").agg(F.count("*").alias("n"))


@query(f"WITH {_LINES} SELECT {_SHARD} AS _shard, count(*) AS n, CAST(1 AS BIGINT) AS parts FROM h GROUP BY 1")
def shard_deal(spark, d):
    """Rows dealt to writers by shard: every shard lies in one partition."""
    dealt = sharding.by_shard(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 40, 7)
    return dealt.withColumn("p", F.spark_partition_id()).groupBy("_shard").agg(F.count("*").alias("n"), F.count_distinct("p").alias("parts"))


def _suffixes(spark, d, unit):
    return table(spark, d, "orders").select("o_orderkey", partitioning.suffix(F.col("o_orderdate"), unit).alias("part"))


@query("SELECT o_orderpriority AS value, 'orders_' || o_orderpriority AS child, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority")
def partition_children(spark, d):
    """The children of a table of the catalog that is partitioned by a list, and the rows that lie in each one's folder."""
    name = f"children_{uuid.uuid4().hex}"
    o = table(spark, d, "orders").where("o_orderpriority IS NOT NULL").select("o_orderkey", "o_orderpriority")
    o.write.partitionBy("o_orderpriority").option("path", work_dir(spark, "children")).saveAsTable(name)
    found = catalog.children(spark, name)
    counts = [spark.read.schema("o_orderkey long").parquet(r["location"]).agg(F.lit(r["value"]).alias("value"), F.count("*").alias("n")) for r in found.collect()]  # a row a partition
    spark.sql(f"DROP TABLE {name}")
    return found.join(reduce(DataFrame.unionByName, counts), "value").select("value", F.replace("child", F.lit(name), F.lit("orders")).alias("child"), "n")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS part FROM orders")
def partition_suffix_day(spark, d):
    return _suffixes(spark, d, "DAY")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS part FROM orders")
def partition_suffix_month(spark, d):
    return _suffixes(spark, d, "MONTH")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || CAST(quarter(o_orderdate) AS VARCHAR) AS part FROM orders")
def partition_suffix_quarter(spark, d):
    return _suffixes(spark, d, "QUARTER")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y') AS part FROM orders")
def partition_suffix_year(spark, d):
    return _suffixes(spark, d, "YEAR")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d-%H') AS part FROM events")
def partition_suffix_hour(spark, d):
    return table(spark, d, "events").select("event_id", partitioning.suffix(F.col("ts"), "HOUR", dashed=True).alias("part"))


@query("""SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || CAST(quarter(o_orderdate) AS VARCHAR) AS part, CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS begins,
CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH AS TIMESTAMP) AS ends,
CAST(year(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH) AS VARCHAR) || CAST(quarter(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH) AS VARCHAR) AS next_part FROM orders""")
def partition_range(spark, d):
    part = F.col("part")
    return _suffixes(spark, d, "QUARTER").select("part").distinct().select(
        "part", partitioning.start(part, "QUARTER").alias("begins"), partitioning.stop(part, "QUARTER").alias("ends"), partitioning.next_suffix(part, "QUARTER").alias("next_part"))


@query("SELECT 'orders_' || strftime(o_orderdate, '%Y%m') AS child, count(*) AS n FROM orders GROUP BY 1")
def partition_route(spark, d):
    o = table(spark, d, "orders")
    return partitioning.route(o, "orders", partitioning.suffix(F.col("o_orderdate"), "MONTH")).groupBy(F.col("_child").alias("child")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS price, CASE WHEN o_orderstatus = 'F' THEN 'none' ELSE o_orderpriority END AS priority,
CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS cust FROM orders""")
def defaults_fill(spark, d):
    status = F.col("o_orderstatus")
    rows = table(spark, d, "orders").select("o_orderkey", F.when(status != "P", F.col("o_totalprice")).alias("price"), F.when(status != "F", F.col("o_orderpriority")).alias("priority"), F.when(status != "O", F.col("o_custkey")).alias("cust"))
    shape = TableDef("t", [ColumnDef("o_orderkey", "bigint", False), ColumnDef("price", "float8", False), ColumnDef("priority", "text", False, "'none'::text"), ColumnDef("cust", "bigint")], ["o_orderkey"])
    return convert.fill_defaults(rows, shape)


@query("SELECT c_custkey, c_name || 'x' AS name, length(c_name || 'x') AS n FROM customer")
def remove_nul(spark, d):
    dirty = F.concat("c_name", F.lit("\x00"), F.lit("x"), F.lit("\x00"))
    return table(spark, d, "customer").select("c_custkey", convert.remove_nul(dirty).alias("name")).withColumn("n", F.length("name").cast("long"))


@query("SELECT o_orderkey, make_timestamp(o_orderkey * 3600000 * 1000) AS at, CAST(make_timestamp(o_orderkey * 3600000 * 1000) AS DATE) AS day FROM orders")
def epoch_ms_convert(spark, d):
    ms = (F.col("o_orderkey") * 3_600_000).cast("string")
    return table(spark, d, "orders").select("o_orderkey", convert.from_epoch_ms(ms, "timestamp").alias("at"), convert.from_epoch_ms(ms, "date").alias("day"))


@query("""SELECT event_id, CASE WHEN event_type = 'click' THEN TIMESTAMP '1970-01-01' WHEN event_type = 'view' THEN NULL ELSE date_trunc('second', ts) END AS at FROM events""")
def timestamp_parse(spark, d):
    shown = F.when(F.col("event_type") == "click", F.lit(convert.ZERO_DATE)).when(F.col("event_type") == "view", F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, d, "events").select("event_id", convert.parse_timestamp(shown).cast("timestamp_ntz").alias("at"))


@query("""SELECT event_type, count(*) FILTER (WHERE event_type <> 'click') AS good, count(*) FILTER (WHERE event_type = 'click') AS bad FROM events GROUP BY event_type""")
def dirty_split(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", F.when(F.col("event_type") == "click", F.lit("twelve")).otherwise(F.col("user_id").cast("string")).alias("user_id"))
    shape = TableDef("t", [ColumnDef("event_id", "bigint", False), ColumnDef("event_type", "text"), ColumnDef("user_id", "int")], ["event_id"])
    good, bad = convert.split_dirty(rows, shape, "skip")
    both = good.select("event_type", F.lit(1).alias("g"), F.lit(0).alias("b")).unionByName(bad.select("event_type", F.lit(0).alias("g"), F.lit(1).alias("b")))
    return both.groupBy("event_type").agg(F.sum("g").alias("good"), F.sum("b").alias("bad"))


@query("SELECT CAST(p_size AS BIGINT) AS size, CAST(p_partkey AS VARCHAR) AS part FROM part")
def widening_cast(spark, d):
    rows = table(spark, d, "part").select(F.col("p_size").cast("short").alias("size"), F.col("p_partkey").alias("part"))
    return widen(rows, TableDef("t", [ColumnDef("size", "bigint"), ColumnDef("part", "text")]).schema())


@query("""SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer""")
def csv_export_import(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"), "c_acctbal")
    path = work_dir(spark, "csv")
    csvio.export_csv(rows, path)
    return csvio.import_csv(spark, path, rows.schema)


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def kafka_json_decode(spark, d):
    from pyspark.sql import types as T

    e = table(spark, d, "events")
    records = e.select(F.col("event_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    return messages.decode(records, T.StructType([T.StructField("k", T.LongType())]), meta={"offset": "event_id"}).where("NOT _bad").select("event_id", "k")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE ts >= TIMESTAMP '2024-01-10'""")
def kafka_start_time(spark, d):
    """Records of a topic from a start time on."""
    from pyspark.sql import types as T

    e = table(spark, d, "events")
    records = e.select(F.col("event_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    start = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return messages.decode(records, T.StructType([T.StructField("k", T.LongType())]), meta={"offset": "event_id"}, start=start).where("NOT _bad").select("event_id", "k")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dashed, strftime(o_orderdate, '%Y%m%d') AS compact FROM orders")
def date_suffixes(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", partitioning.date_suffix(day).alias("dashed"), partitioning.date_suffix(day, compact=True).alias("compact"))


@query("SELECT event_type AS target, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def multi_table_route(spark, d):
    """A stream whose rows go to the keyed table of their type, read back."""
    folder = work_dir(spark, "route")
    e = table(spark, d, "events").where("event_type IS NOT NULL").select("event_id", F.col("event_type").alias("tablename"), F.get_json_object("props", "$.k").cast("long").alias("k"))
    e.repartition(2).write.parquet(f"{folder}/rows")
    targets = {r[0]: KeyedTable(spark, f"{folder}/t{i}", ["event_id"], 4) for i, r in enumerate(e.select("tablename").distinct().collect())}  # a row a table
    for t in targets.values():
        t.create(e.select("event_id", "k").limit(0))
    stream = spark.readStream.schema(e.schema).parquet(f"{folder}/rows")
    sinks.route_stream(stream, targets, f"{folder}/checkpoint", lambda rows: rows.withColumn("_seq", F.col("event_id"))).awaitTermination()
    read = [t.read().select(F.lit(name).alias("target"), "k") for name, t in targets.items()]
    return reduce(DataFrame.unionByName, read).groupBy("target").agg(F.count("*").alias("n"), F.sum("k").alias("k"))


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL")
def uv_stream(spark, d):
    """Distinct users of an hour from a stream with a watermark, its updates merged into a keyed table of bitmaps."""
    folder = work_dir(spark, "uv")
    e = table(spark, d, "events").select("event_type", "ts", "user_id").withColumn("ts", F.col("ts").cast("timestamp"))
    e.write.parquet(f"{folder}/events")
    made = lambda rows: windows.window_bitmaps(rows, "ts", "user_id", ["event_type"], 3600)
    target = KeyedTable(spark, f"{folder}/table", ["event_type", "window_end", "bucket"], 8)
    target.create(made(e.limit(0)))
    sinks.upsert_rows(made(spark.readStream.schema(e.schema).parquet(f"{folder}/events")), target, f"{folder}/checkpoint", "bucket").awaitTermination()
    return target.read().groupBy("event_type", F.col("window_end").cast("timestamp_ntz").alias("window_end")).agg(F.sum(F.bitmap_count("bitmap")).alias("uv"))


@query("""WITH w AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, user_id FROM events)
SELECT event_type, window_end, count(DISTINCT user_id) AS uv FROM w WHERE window_end <= (SELECT max(ts) FROM events) GROUP BY event_type, window_end""")
def uv_early(spark, d):
    """Distinct users of an hour from a stream of several micro-batches that gives counts every three minutes of event time; those of windows that have ended."""
    folder = work_dir(spark, "early")
    e = table(spark, d, "events").select("event_type", "ts", "user_id").withColumn("ts", F.col("ts").cast("timestamp"))
    write_in_order(e, F.unix_micros("ts"), 4, f"{folder}/events")
    target = KeyedTable(spark, f"{folder}/table", ["event_type", "window_end", "bucket"], 8)
    counts = lambda rows: early.early_counts(rows, "ts", "user_id", ["event_type"], 3600)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    made = counts(stream)
    target.create(spark.createDataFrame([], made.schema))
    sinks.upsert_rows(made, target, f"{folder}/checkpoint", "given_at").awaitTermination()
    ended = target.read().where("given_at >= window_end")
    return ended.groupBy("event_type", F.col("window_end").cast("timestamp_ntz").alias("window_end")).agg(F.sum("uv").alias("uv"))


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS seg, CAST(c_custkey * 86400 AS BIGINT) AS seconds FROM customer")
def load_rows(spark, d):
    """Foreign rows, all text, mapped to a table's types and merged; the second row of a key replaces the first."""
    c = table(spark, d, "customer")
    text = c.select(F.col("c_custkey").cast("string"), F.concat("c_name", F.lit("\x00")), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise(""), F.date_format(F.timestamp_seconds(F.col("c_custkey") * 86400), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    shape = TableDef("t", [ColumnDef("id", "bigint", False), ColumnDef("name", "text"), ColumnDef("seg", "text"), ColumnDef("at", "timestamptz")], ["id"])
    target = KeyedTable(spark, work_dir(spark, "load"), ["id"], 8)
    target.create(spark.createDataFrame([], shape.schema()))
    older = text.withColumn(text.columns[1], F.lit("old"))
    loader.load(older, target, shape)
    loader.load(text, target, shape)
    return target.read().select("id", "name", "seg", F.unix_seconds("at").alias("seconds"))


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def ship_database(spark, d):
    """Two tables and a view exported, imported elsewhere, and the view read."""
    path = work_dir(spark, "ship")
    view = "SELECT n_name, count(*) AS n FROM shipped_customer JOIN shipped_nation ON c_nationkey = n_nationkey GROUP BY n_name"
    catalog.export_database(spark, {"shipped_customer": table(spark, d, "customer"), "shipped_nation": table(spark, d, "nation")}, path, {"shipped_view": view})
    catalog.import_database(spark, path)
    return spark.table("shipped_view")


@query("""SELECT o_orderstatus AS object, o_orderpriority AS grantee, string_agg(DISTINCT 'p' || (o_custkey % 5), ',' ORDER BY 'p' || (o_custkey % 5)) AS privileges FROM orders GROUP BY ALL""")
def privilege_rollup(spark, d):
    grants = table(spark, d, "orders").select(F.col("o_orderstatus").alias("object"), F.col("o_orderpriority").alias("grantee"), F.concat(F.lit("p"), (F.col("o_custkey") % 5).cast("string")).alias("privilege"))
    return catalog.privileges(grants)


@query("SELECT event_id, epoch_us(date_trunc('second', ts)) AS iso, epoch_us(date_trunc('second', ts)) - 7200000000 AS shifted FROM events")
def offset_times(spark, d):
    """Start times of a subscription, in ISO form and with an offset."""
    at = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select(
        "event_id", convert.offset_micros(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso"), convert.offset_micros(F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00"))).alias("shifted"))


@query("SELECT c_custkey, rpad(c_name, 24, ' ') AS padded, substring(c_name, 1, 12) AS short FROM customer")
def char_lengths(spark, d):
    return table(spark, d, "customer").select("c_custkey", convert.fit_length(F.col("c_name"), "char", 24).alias("padded"), convert.fit_length(F.col("c_name"), "varchar", 12).alias("short"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE [c_custkey, c_nationkey] END AS ids FROM customer")
def array_values(spark, d):
    """Delimited text to an array of numbers, elements that are none left out."""
    text = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.concat_ws("|", F.col("c_custkey").cast("string"), F.lit("none"), F.col("c_nationkey").cast("string")))
    return table(spark, d, "customer").select("c_custkey", convert.compact(convert.split_array(text, "|", "bigint")).alias("ids"))


@query("""SELECT o_orderkey, '{"a":' || o_custkey || ',"b":"' || o_orderstatus || '"}' AS doc FROM orders""")
def json_normal_form(spark, d):
    loose = F.concat(F.lit('{ "b" : "'), "o_orderstatus", F.lit('",  "a": '), F.col("o_custkey").cast("string"), F.lit(" }"))
    return table(spark, d, "orders").select("o_orderkey", convert.normalise_json(loose).alias("doc"))


@query("SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def with_options(spark, d):
    clause = F.concat(F.lit("CREATE TABLE t (x int) WITH ('name' = 'first', 'nation'='"), F.col("c_nationkey").cast("string"), F.lit("', 'name' = '"), "c_name", F.lit("')"))
    found = text.options(clause)
    return table(spark, d, "customer").select("c_custkey", found["name"].alias("name"), found["nation"].alias("nation"))
