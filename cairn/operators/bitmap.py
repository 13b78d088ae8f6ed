"""Exact distinct counts from mergeable bitmaps.

Ids are kept as words of 64 bits, one row for each group and word that holds an id, so the
bytes follow the ids: a lone id takes one row, a full word one row for 64. Building and
merging are ``bit_or`` aggregations with partial results of eight bytes, counting is a sum
of set bits; no buffer has the size of an id range, and no step leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 64


def build(df: DataFrame, by: Sequence[str | Column], ids: str) -> DataFrame:
    """Group columns, ``word`` and ``bits`` of the non-null ids, whole numbers of any sign."""
    at = F.col(ids).cast("long")
    one = F.expr(f"shiftleft(1L, CAST(pmod(CAST(`{ids}` AS BIGINT), {_BITS}) AS INT))")
    return df.where(at.isNotNull()).groupBy(*by, F.shiftright(at, 6).alias("word")).agg(F.bit_or(one).alias("bits"))


def merge(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Union of stored bitmaps over a subset of their group columns."""
    return bitmaps.groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))


def intersect(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """The ids that both have, where the group columns ``by`` agree; other group columns of ``a`` stay."""
    there = b.select(*[F.col(c).alias(f"_b_{c}") for c in by], F.col("word").alias("_b_word"), F.col("bits").alias("_b_bits"))
    match = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by] + [F.col("word") == F.col("_b_word")]
    both = a.join(there, match).select(*[c for c in a.columns if c not in ("word", "bits")], "word", F.col("bits").bitwiseAND(F.col("_b_bits")).alias("bits"))
    return both.where("bits <> 0")


def cardinality(bitmaps: DataFrame, by: Sequence[str], name: str = "uv") -> DataFrame:
    """Exact number of distinct ids for a subset of the group columns."""
    return merge(bitmaps, by).groupBy(*by).agg(F.sum(F.bit_count("bits")).alias(name))


def rollup(bitmaps: DataFrame, by: Sequence[str], name: str = "uv", cube: bool = False) -> DataFrame:
    """Exact distinct counts for every prefix (or subset) of the group columns; ``grouping_id`` tells them apart."""
    sets = [[c for i, c in enumerate(by) if m >> i & 1] for m in range(1 << len(by))] if cube else [list(by[:n]) for n in range(len(by) + 1)]
    per = bitmaps.groupingSets([[*s, "word"] for s in sets], *by, "word").agg(F.grouping_id().alias("_g"), F.bit_or("bits").alias("bits"))
    # the word is in every set: its bit, the last, is zero
    return per.groupBy(*by, F.floor(F.col("_g") / 2).alias("grouping_id")).agg(F.sum(F.bit_count("bits")).alias(name))


def ids(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per id of each group; the form to use where a group may be large."""
    places = F.filter(F.sequence(F.lit(0), F.lit(_BITS - 1)), lambda i: F.getbit("bits", i) == 1)
    return bitmaps.select(*by, "word", F.explode(places).alias("_p")).select(*by, (F.col("word") * _BITS + F.col("_p")).cast("long").alias("id"))


def to_array(bitmaps: DataFrame, by: Sequence[str], name: str = "ids") -> DataFrame:
    """Sorted array of the ids of each group, as far as an array may hold them."""
    return ids(bitmaps, by).groupBy(*by).agg(F.array_sort(F.collect_list("id")).alias(name))
