"""Dimension lookups, including lookup with insert-if-missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import ranges

#: Rows of each side in a group of a spread lookup, and pairs of a task.
SIDE_ROWS, TASK_PAIRS = 1_000, 4_000_000


def lookup(facts: DataFrame, dim: DataFrame, on: dict[str, str], columns: Sequence[str] | None = None, how: str = "left") -> DataFrame:
    """Join each fact row with the dimension rows whose columns equal the fact's.

    On the primary key there is one match at most; on other columns any number. In a
    stream the dimension is that of the micro-batch. Whether the dimension is broadcast
    is left to Spark, which checks its size.
    """
    wanted = [c for c in dim.columns if c not in on.values()] if columns is None else list(columns)
    side = dim.select(*[F.col(d).alias(f"_k{i}") for i, d in enumerate(on.values())], *wanted)
    match = [F.col(f) == F.col(f"_k{i}") for i, f in enumerate(on)]
    return facts.join(side, match, how).drop(*[f"_k{i}" for i in range(len(on))])


def lookup_many(facts: DataFrame, dim: DataFrame, on: dict[str, str], columns: Sequence[str] | None = None, how: str = "left") -> DataFrame:
    """``lookup`` on columns that are no key, where few values may give very many pairs (``how``: left or inner).

    Pairs of each value are counted first. Where there are more than ``TASK_PAIRS``, both
    sides of a value are cut into parts of about ``SIDE_ROWS`` rows by a hash, each part of
    one meets each part of the other in a group, and there are as many tasks as the number
    of pairs asks for, whatever the size of the input.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"no such lookup: {how}")
    common = facts.select(*on).limit(0).union(dim.select(*on.values()).limit(0)).schema
    keys = [f"_k{i}" for i in range(len(on))]
    alike = lambda names: [F.col(n).cast(f.dataType).alias(k) for n, f, k in zip(names, common, keys, strict=True)]
    rows = lambda df, names, n: df.select(*alike(names)).na.drop().groupBy(*keys).agg(F.count("*").alias(n))
    pairs = rows(facts, on, "_f").join(rows(dim, on.values(), "_d"), keys)
    total = pairs.agg(F.sum(F.col("_f").cast("double") * F.col("_d"))).first()[0] or 0
    if total <= TASK_PAIRS:
        return lookup(facts, dim, on, columns, how)
    parts = lambda n: F.ceil(F.col(n) / SIDE_ROWS).cast("int")
    cuts = F.broadcast(pairs.where((F.col("_f") > SIDE_ROWS) | (F.col("_d") > SIDE_ROWS)).select(*keys, parts("_f").alias("_a"), parts("_d").alias("_b")))  # a value for SIDE_ROWS rows at most
    wanted = [c for c in dim.columns if c not in on.values()] if columns is None else list(columns)

    def dealt(df: DataFrame, names: Sequence[str], own: str, other: str, *keep: Column) -> DataFrame:
        hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
        cut = df.withColumns(dict(zip(keys, alike(names), strict=True))).join(cuts, keys, "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_a", "_b")})
        place = {own: F.pmod(F.xxhash64(*hashed), own), other: F.explode(F.sequence(F.lit(0), F.col(other) - 1))}
        copies = cut.withColumn("_many", F.col("_b") > 1).withColumn("_own", place[own].cast("int")).withColumn("_other", place[other])
        at = {own: "_own", other: "_other"}
        whole = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
        return copies.select(*keep, F.when(whole, F.struct(*keys, at["_a"], at["_b"])).alias("_g"))

    tasks = max(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // TASK_PAIRS))
    left = dealt(facts, list(on), "_a", "_b", *[F.col(c) for c in facts.columns], F.col("_many"))
    right = dealt(dim, list(on.values()), "_b", "_a", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(wanted)]).where("_g IS NOT NULL")
    met = left.repartition(tasks, "_g").join(right.repartition(tasks, "_g"), "_g", how).where("_hit IS NOT NULL OR NOT _many")
    return met.select(*facts.columns, *[F.col(f"_v{i}").alias(c) for i, c in enumerate(wanted)])


def missing_keys(facts: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct non-null keys of the facts that the dimension lacks, named as in the dimension."""
    asked = facts.select(*[F.col(f).alias(d) for f, d in on.items()]).na.drop().distinct()
    return asked.join(dim, list(on.values()), "left_anti")


def dense_ids(keys: DataFrame, order: Sequence[str], start: int | Column = 0, name: str = "id") -> DataFrame:
    """Number rows ``start`` + 1, + 2, ... in key order without sorting all rows in one task."""
    return ranges.numbered(keys, name, [], order, start)


def lookup_or_insert(facts: DataFrame, dim: DataFrame, on: dict[str, str], serial: str) -> tuple[DataFrame, DataFrame]:
    """(facts with the dimension's columns, the dimension with a row for every missing key).

    New rows get the serial ids after the largest one, in key order.
    """
    new = missing_keys(facts, dim, on)
    largest = dim.agg(F.coalesce(F.max(serial), F.lit(0)).cast("long")).first()[0]
    added = dense_ids(new, list(on.values()), largest, serial)
    rest = [c for c in dim.columns if c not in {*on.values(), serial}]
    grown = dim.unionByName(added.select(*on.values(), F.col(serial).cast(dim.schema[serial].dataType).alias(serial), *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in rest]))
    return lookup(facts, grown, on), grown
