"""Connected components over an edge table by alternating large and small stars.

Both steps are aggregations with partial sums and joins on the vertex, so no
neighbourhood is ever gathered in one task; each round is stored in the shared
folder, and the round before it deleted. The aggregated side of a join is rebalanced
first: then both sides are dealt out for the join alone, and the skew-join rule may
split a node with very many edges.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import shared_dir
from cairn.session import remove_dir


def components(edges: DataFrame, most_rounds: int = 60, folder: str | None = None) -> DataFrame:
    """(u, v) edges of any direction to (node, root); root is the smallest node reachable.

    Nodes without an edge have no row. The result is read from a table below ``folder``.
    """
    spark = edges.sparkSession
    folder = f"{folder or shared_dir(spark)}/components-{uuid.uuid4().hex}"

    def keep(df: DataFrame, k: int) -> DataFrame:
        df.write.parquet(f"{folder}/{k}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{k}")

    edges = keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), 0)
    seen = None
    for k in range(1, most_rounds + 1):
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == now or now["n"] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now
        edges = keep(_small_star(_large_star(edges)), k)
        remove_dir(spark, f"{folder}/{k - 1}")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).hint("rebalance")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).hint("rebalance")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
