"""A trie of conversation prefixes by preorder intervals.

A turn is the SHA-256 of its role and text. Conversations are taken in blocks of ``BLOCK``
turns; the contents of the blocks are ranked and stand for the turns of a shorter
conversation, again and again until each is one block. So distinct conversations are
ranked in lexicographic order, however long they are, and prefixes get names (chained
digests) by the same blocks; no conversation is ever held whole.

In that order a node is made by the first conversation that passes it, and comes after
those made before it and those above it: (rank, depth) is its place in preorder. Its
subtree ends where the last conversation that passes it ends. Running sums of leaves and
savings over this order are worked out in range partitions and put together from one row
a partition; a subtree's sum is the difference of two of them. Of copies of one
conversation only one is expanded, with their number.

The ids that end at a node are hashed in numeric order without being gathered: sorted
range partitions join them to pieces of bounded size, and a hash runs over the pieces.

Defined results: turns with equal numbers are in the order of role and text, repeated rows
are turns each; rows without a conv_id belong to no conversation; an empty table gives no
rows, no root either; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import session_of, shared_dir, stored

#: Turns, or names of blocks, that are handled as one value.
BLOCK = 64
#: Bytes of a piece of joined ids.
PIECE_BYTES = 64 << 10
#: Conversations that share their first turns, and the most that they share.
FAMILY, HEADS = 100, 6
_EMPTY = hashlib.sha256(b"").hexdigest()
_SUMMED = "part int, at long, "


def _sums_in_order(rows: DataFrame, order: list[str], values: list[str], folder: str) -> DataFrame:
    """The rows, stored, with ``sum_<value>``: the sum of a long column over all rows up to each, in a total order.

    Sorted range partitions are added up on their own; what comes before a partition is added from one row for each.
    """
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), np.zeros(len(values), np.int64)
        for batch in batches:
            sums = []
            for k, v in enumerate(values):
                sums.append(np.cumsum(batch.column(v).to_numpy(zero_copy_only=False)) + held[k])
                held[k] = sums[-1][-1] if len(sums[-1]) else held[k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, part), pa.int32()), *batch.columns, *map(pa.array, sums)], names=["part", *names, *(f"sum_{v}" for v in values)])

    schema = ", ".join(["part int", *(f"{n} {t}" for n, t in rows.dtypes), *(f"sum_{v} long" for v in values)])
    parted = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(work, schema), folder)
    ends = sorted(parted.groupBy("part").agg(*[F.max(f"sum_{v}") for v in values]).collect())  # one row a partition
    before = dict(zip((r[0] for r in ends), np.cumsum([[0] * len(values), *([x or 0 for x in r[1:]] for r in ends)], axis=0).tolist(), strict=False))
    starts = rows.sparkSession.createDataFrame([(p, *s) for p, s in before.items()], "part int, " + ", ".join(f"before_{v} long" for v in values))
    joined = parted.join(F.broadcast(starts), "part")
    return joined.select(*names, *[(F.col(f"sum_{v}") + F.col(f"before_{v}")).alias(f"sum_{v}") for v in values])


def numbered_turns(rows: DataFrame, folder: str) -> DataFrame:
    """(c, pos, turn, points): the turns of each conversation from 1 on, as digests with the code points of their texts."""
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    turns = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("k"), text("role").alias("role"), text("text").alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            c = batch.column("c").to_numpy()
            if not len(c):
                continue
            new = np.flatnonzero(np.concatenate([[c[0] != last], c[1:] != c[:-1]]))
            start = np.zeros(len(c), np.int64)
            start[new] = new
            own = np.arange(len(c)) - np.maximum.accumulate(start) + 1
            own[: new[0] if len(new) else len(c)] += seen
            last, seen = c[-1], int(own[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), part), pa.int32()), batch.column("c"), pa.array(own), batch.column("turn"), batch.column("points")], names=["part", "c", "own", "turn", "points"])

    order = ["c", F.col("k").asc_nulls_first(), "role", "text"]
    laid = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("c", digest.alias("turn"), F.char_length("text").cast("long").alias("points"))
    parted = stored(laid.mapInArrow(work, "part int, c long, own long, turn binary, points long"), folder)
    # only a conversation cut by a partition's end has turns before its first one here: at most one for each partition
    spans = parted.groupBy("c").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b")
    cut = parted.join(spans.select("c"), "c", "left_semi").groupBy("c", "part").agg(F.max("own").alias("n")).collect()
    before, sums = [], {}
    for c, part, n in sorted(cut):
        before.append((c, part, sums.get(c, 0)))
        sums[c] = sums.get(c, 0) + n
    starts = F.broadcast(rows.sparkSession.createDataFrame(before, "c long, part int, start long"))
    joined = parted.join(starts, ["c", "part"], "left")
    return joined.select("c", (F.col("own") + F.coalesce("start", F.lit(0))).alias("pos"), "turn", "points")


def rebuilt(turns: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The conversations as (c, n turns) and their turns, the first ones from the first of the family.

    At most ``HEADS`` - 1 turns of a family's first are given to each of its at most 2 * ``FAMILY`` - 1 conversations.
    """
    own = turns.groupBy("c").agg(F.max("pos").alias("own"))
    shared = F.crc32(F.col("c").cast("string").cast("binary")) % HEADS
    convs = own.withColumn("base", F.col("c") - F.col("c") % FAMILY).withColumn("h", shared)
    of = own.where(F.col("c") % FAMILY == 0).select(F.col("c").alias("base"), F.col("own").alias("there"))
    convs = stored(convs.join(of, "base", "left").withColumn("heads", F.least("h", F.coalesce("there", F.lit(0)))), folder)
    heads = turns.where((F.col("c") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("c", "base")
    first = convs.where("heads > 0").join(heads, "base").where("pos <= heads").select("c", "pos", "turn", "points")
    rest = turns.join(convs.select("c", "h", "heads").hint("rebalance"), "c").where("pos > h").select("c", (F.col("pos") - F.col("h") + F.col("heads")).alias("pos"), "turn", "points")
    return convs.select("c", (F.col("heads") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), first.unionByName(rest)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(c, block from 0, items): the (pos, turn, points) of up to ``size`` turns in order."""
    at = F.floor((F.col("pos") - 1) / size).cast("long")
    return rows.groupBy("c", at.alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "points"))).alias("items"))


def _content(items: str = "items") -> Column:
    return F.aggregate(items, F.lit(b""), lambda held, x: F.concat(held, x["turn"]))


def _one_block(blocks: DataFrame) -> bool:
    return blocks.where("block > 0").isEmpty()


def sequences(blocks: DataFrame, folder: str, size: int) -> DataFrame:
    """(c, content) of every conversation with a turn: contents are equal or less as the conversations are, turn by turn."""
    while not _one_block(blocks):
        found = stored(blocks.select("c", "block", _content().alias("content")).withColumn("key", F.sha2("content", 256)), folder)
        ranked = _sums_in_order(found.groupBy("key").agg(F.any_value("content").alias("content"), F.lit(1).cast("long").alias("one")), ["content"], ["one"], folder)
        name = F.unhex(F.lpad(F.hex("sum_one"), 16, "0"))
        named = found.select("c", "block", "key").join(ranked.select("key", name.alias("turn")).hint("rebalance"), "key")
        blocks = stored(_blocks(named.select("c", (F.col("block") + 1).alias("pos"), "turn", F.lit(0).cast("long").alias("points")), size), folder)
    return blocks.select("c", _content().alias("content"))


def names(blocks: DataFrame, folder: str, size: int) -> DataFrame:
    """(c, pos, id, parent, points): a digest that names the prefix up to each turn, and that of the prefix before it."""
    start = F.lit(b"").alias("start")
    if _one_block(blocks):
        blocks = blocks.withColumns({"start": start, "end": F.lit(None).cast("binary")})
    else:
        whole = blocks.select("c", (F.col("block") + 1).alias("pos"), F.unhex(F.sha2(_content(), 256)).alias("turn"), F.lit(0).cast("long").alias("points"))
        upper = names(stored(_blocks(whole, size), folder), folder, size).select("c", (F.col("pos") - 1).alias("block"), F.col("parent").alias("start"), F.col("id").alias("end"))
        blocks = blocks.join(upper, ["c", "block"])
    chain = F.aggregate("items", F.array("start"), lambda held, x: F.concat(held, F.array(F.unhex(F.sha2(F.concat(F.element_at(held, -1), x["turn"]), 256)))))
    made = blocks.withColumn("chain", chain)
    # the end of a full block has the name that the row of blocks gives it
    row = lambda x, i: F.struct(x["pos"].alias("pos"), F.when((i == size - 1) & F.col("end").isNotNull(), F.col("end")).otherwise(F.get("chain", i + 1)).alias("id"), F.get("chain", i).alias("parent"), x["points"].alias("points"))
    return made.select("c", F.explode(F.transform("items", row)).alias("r")).select("c", "r.*")


def ends(members: DataFrame) -> DataFrame:
    """(rank, sha256) over the ids ``c`` of each rank in numeric order, joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[int, int, bytes]]:
            rank, first, held, size = None, None, [], 0
            for batch in batches:
                for r, c in zip(batch.column("rank").to_pylist(), batch.column("c").to_pylist(), strict=True):
                    if r != rank or size > PIECE_BYTES:
                        if held:
                            yield rank, first, b",".join(held)
                        rank, first, held, size = r, c, [], 0
                    held.append(b"%d" % c)
                    size += len(held[-1]) + 1
            if held:
                yield rank, first, b",".join(held)

        yield from _tables(pieces(), _PIECES)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple[int, str]]:
            rank, hasher = None, None
            for batch in batches:
                for r, piece in zip(batch.column("rank").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                    if r == rank:
                        hasher.update(b",")
                    else:
                        if hasher:
                            yield rank, hasher.hexdigest()
                        rank, hasher = r, hashlib.sha256()
                    hasher.update(piece)
            if hasher:
                yield rank, hasher.hexdigest()

        yield from _tables(digests(), _DIGESTS)

    made = members.select("rank", "c").repartitionByRange("rank", "c").sortWithinPartitions("rank", "c").mapInArrow(join, "rank long, first long, piece binary")
    return made.repartition("rank").sortWithinPartitions("rank", "first").mapInArrow(digest, "rank long, sha256 string")


_PIECES = pa.schema([("rank", pa.int64()), ("first", pa.int64()), ("piece", pa.binary())])
_DIGESTS = pa.schema([("rank", pa.int64()), ("sha256", pa.string())])


def _tables(rows: Iterator[tuple], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def prefix_trie(conversations: DataFrame, rebuild: Callable[[DataFrame, str], tuple[DataFrame, DataFrame]] | None = None, size: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuild`` makes (c, n) and (c, pos, turn, points) from the numbered turns; by default conversations are taken as they are.
    """
    spark = session_of(conversations)
    folder = f"{shared_dir(spark)}/trie-{uuid.uuid4().hex}"
    turns = numbered_turns(conversations, folder)
    convs, turns = rebuild(turns, folder) if rebuild else (turns.groupBy("c").agg(F.max("pos").alias("n")), turns)
    blocks = stored(_blocks(turns, size), folder)

    # distinct conversations in lexicographic order; one of each stands for its copies
    keyed = convs.join(sequences(blocks, folder, size), "c", "left").withColumn("content", F.coalesce("content", F.lit(b"")))
    keyed = stored(keyed.withColumn("key", F.sha2("content", 256)), folder)
    distinct = keyed.groupBy("key").agg(F.any_value("content").alias("content"), F.min("c").alias("c"), F.any_value("n").alias("n"), F.count("*").alias("copies"), F.lit(1).cast("long").alias("one"))
    ranked = _sums_in_order(distinct, ["content"], ["one"], folder).select("key", "c", "n", "copies", F.col("sum_one").alias("rank"))
    told = ends(keyed.select("c", "key").join(ranked.select("key", "rank").hint("rebalance"), "key"))

    chosen = ranked.select("c", "n", "copies", "rank")
    passed = names(blocks.join(chosen.select("c").hint("rebalance"), "c", "left_semi"), folder, size).join(chosen.hint("rebalance"), "c")
    tops = chosen.select("c", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("points"), "n", "copies", "rank")
    nodes = stored(passed.select(*tops.columns).unionByName(tops).groupBy(F.col("pos").alias("depth"), "id").agg(
        F.min("c").alias("conv_id"), F.sum("copies").alias("n_convs"), F.min("rank").alias("first"), F.max("rank").alias("last"),
        F.any_value("points").alias("points"), F.any_value("parent").alias("parent"), F.max(F.col("pos") == F.col("n")).alias("final")), folder)

    children = nodes.where("parent IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    leaf, saved = (F.col("final") & (F.col("first") == F.col("last"))).cast("long"), (F.col("n_convs") - 1) * F.col("points")
    summed = _sums_in_order(nodes.join(children, ["depth", "id"], "left").withColumns({"leaf": leaf, "saved": saved}), ["first", "depth"], ["leaf", "saved"], folder)
    ending = summed.where("final").select(F.col("first").alias("last"), F.col("sum_leaf").alias("end_leaf"), F.col("sum_saved").alias("end_saved"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    finals = told.select(F.lit(True).alias("final"), F.col("rank").alias("first"), "sha256")
    found = summed.join(ending.hint("rebalance"), "last").join(finals.hint("rebalance"), ["final", "first"], "left").join(above.hint("rebalance"), ["depth", "parent"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        (F.col("end_leaf") - F.col("sum_leaf") + F.col("leaf")).alias("n_leaves"), (F.col("end_saved") - F.col("sum_saved") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), rebuilt)


OP12_SQL = """
WITH bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, x: xor(a >> 1, CASE WHEN (a & 1) = 1 THEN 3988292384 ELSE 0 END))) AS t),
o AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, max(k) AS n FROM o GROUP BY c),
h AS (SELECT c, n, c - c % 100 AS base, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 6 AS h FROM n, bits),
g AS (SELECT h.c, h.n, h.base, h.h, least(h.h, coalesce(b.n, 0)) AS heads FROM h LEFT JOIN n b ON b.c = h.base),
p AS (SELECT g.c, o.k, o.r, o.x FROM g JOIN o ON o.c = g.base AND o.k <= g.heads
  UNION ALL SELECT g.c, o.k - g.h + g.heads, o.r, o.x FROM g JOIN o ON o.c = g.c AND o.k > g.h),
w AS (SELECT c, k, x, list({'r': r, 'x': x}) OVER (PARTITION BY c ORDER BY k) AS path FROM p
  UNION ALL SELECT c, 0, '', [] FROM g),
v AS (SELECT c, k, length(x) AS points, sha256(to_json(path) || k) AS id, k = max(k) OVER (PARTITION BY c) AS ends FROM w),
e AS (SELECT a.c, a.k, a.id, a.points, a.ends, b.id AS parent FROM v a LEFT JOIN v b ON a.c = b.c AND a.k = b.k + 1),
m AS (SELECT id, any_value(k) AS depth, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM e GROUP BY id),
q AS (SELECT m.*, (SELECT count(*) FROM m d WHERE d.parent = m.id) AS n_children FROM m),
s AS (SELECT DISTINCT a.id, b.id AS under FROM v a JOIN v b ON a.c = b.c AND b.k >= a.k),
u AS (SELECT s.id, count(*) FILTER (WHERE q.n_children = 0) AS n_leaves, sum((q.n_convs - 1) * q.points) AS saved FROM s JOIN q ON q.id = s.under GROUP BY s.id)
SELECT q.conv_id, CAST(q.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, q.n_convs, q.n_children, u.n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, q.ends_sha256
FROM q JOIN u ON u.id = q.id LEFT JOIN q a ON a.id = q.parent
"""

QUERIES = {"op12_conversation_trie": op12_conversation_trie}
ORACLES = {"op12_conversation_trie": OP12_SQL}
