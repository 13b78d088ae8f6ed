"""Stable hash sharding: 32-bit murmur3 of each value's text over 65,536 ranges."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from cairn.schema import TableDef

#: Seed of the hash and number of ranges.
SEED, RANGE = 104729, 65536


def _rotate(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint32(r)) | (x >> np.uint32(32 - r))


def murmur3(values: list[bytes], seed: int = SEED) -> np.ndarray:
    """murmur3_x86_32 of each value, computed together for values of equal length."""
    out = np.empty(len(values), np.uint32)
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        data = np.frombuffer(b"".join([values[i] for i in at]), np.uint8).reshape(len(at), n)
        blocks, rest = n // 4, n % 4
        h = np.full(len(at), seed, np.uint32)
        words = np.ascontiguousarray(data[:, : 4 * blocks]).view("<u4") if blocks else np.empty((len(at), 0), np.uint32)
        for b in range(blocks):
            h = _rotate(h ^ _rotate(words[:, b] * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593), 13) * np.uint32(5) + np.uint32(0xE6546B64)
        if rest:
            k = np.zeros(len(at), np.uint32)
            for i in range(rest):
                k |= data[:, 4 * blocks + i].astype(np.uint32) << np.uint32(8 * i)
            h ^= _rotate(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h ^= np.uint32(n)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        out[at] = h ^ (h >> np.uint32(16))
    return out.view(np.int32)


#: Hash that a null counts with.
NULL_HASH = int(murmur3([b""]).view(np.uint32)[0] % RANGE)


@pandas_udf(T.IntegerType())
def _hash_text(values: pd.Series) -> pd.Series:
    null = values.isna().to_numpy()
    found = murmur3([v.encode() if isinstance(v, str) else bytes(v) if v is not None else b"" for v in values])
    return pd.Series(np.where(null, NULL_HASH, found).astype(np.int32))


@pandas_udf(T.IntegerType())
def _hash_bytes(values: pd.Series) -> pd.Series:
    null = values.isna().to_numpy()
    found = murmur3([bytes(v) if v is not None else b"" for v in values])
    return pd.Series(np.where(null, NULL_HASH, found).astype(np.int32))


@pandas_udf(T.IntegerType())
def _hash_list(values: pd.Series) -> pd.Series:
    out = []
    for texts in values:
        if texts is None:
            out.append(NULL_HASH)
            continue
        h = 0
        known = murmur3([t.encode() for t in texts if t is not None]).tolist()
        for t in texts:
            h = (h * 31 + (0 if t is None else known.pop(0))) & 0xFFFFFFFF
        out.append(h - (1 << 32) if h >> 31 else h)
    return pd.Series(out, dtype="int32")


def stored(value: Column, kind: T.DataType) -> Column:
    """The form of a value that is hashed: times as numbers, decimals as 16 little-endian bytes."""
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(value).cast("string")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("string")
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("string")
    return value.cast("string")


@pandas_udf(T.BinaryType())
def _decimal_bytes(values: pd.Series) -> pd.Series:
    def one(v):
        if v is None:
            return None
        unscaled = int(v.scaleb(-v.as_tuple().exponent))
        size = (unscaled + (unscaled < 0)).bit_length() // 8 + 1
        return unscaled.to_bytes(size, "little", signed=True).ljust(16, b"\x00")  # the stored form is extended with zeros, for negatives too

    return values.map(one)


def hash_value(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return _hash_bytes(value)
    if isinstance(kind, T.DecimalType):
        return _hash_bytes(_decimal_bytes(value))
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        return _hash_list(F.transform(value, lambda v: stored(v, inner)))
    return _hash_text(stored(value, kind))


def record_hash(df: DataFrame, key: Sequence[str]) -> Column:
    """Hashes of the key's columns, joined by exclusive or; random where there is no key."""
    if not key:
        return (F.rand() * (1 << 31)).cast("int")
    out = None
    for k in key:
        h = hash_value(F.col(k), df.schema[k].dataType)
        out = h if out is None else out.bitwiseXOR(h)
    return out


def hash_columns(table: TableDef) -> list[str]:
    """The columns whose values place a table's row: its distribution key, else its primary key, without generated columns."""
    generated = {c.name for c in table.columns if c.generated}
    return [k for k in table.distribution_key or table.primary_key if k not in generated]


def shard_of(hash_: Column, shards: int) -> Column:
    """Shard of a hash: 65,536 ranges dealt evenly, the first ones a range longer if they don't divide."""
    base, longer = divmod(RANGE, shards)
    place = F.pmod(hash_.cast("long"), F.lit(RANGE))
    pivot = (base + 1) * longer
    return F.when(place < pivot, F.floor(place / (base + 1))).otherwise(longer + F.floor((place - pivot) / max(1, base))).cast("int")


def with_shard(df: DataFrame, key: Sequence[str], shards: int, name: str = "_shard") -> DataFrame:
    return df.withColumn(name, shard_of(record_hash(df, key), shards))


def by_shard(df: DataFrame, key: Sequence[str], shards: int, writers: int) -> DataFrame:
    """Deal rows so that each of the writers' partitions holds whole shards."""
    return with_shard(df, key, shards).repartitionById(writers, F.pmod("_shard", F.lit(writers)).cast("int"))


def ranges(shards: int) -> list[tuple[int, int]]:
    """The half-open range of each shard."""
    base, longer = divmod(RANGE, shards)
    ends = [(i + 1) * base + min(i + 1, longer) for i in range(shards)]
    return list(zip([0, *ends[:-1]], ends, strict=True))
