"""Helpers that the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import shared_root

#: Bytes of an Arrow batch: whole texts can be long, so batches are bounded by size.
ARROW_BYTES = 4 << 20
#: Bits of a Bloom filter for each row key, and powers of two that bound its size: 128 KB to 32 MB.
FILTER_SHARE, FILTER_LEAST, FILTER_MOST = 16, 20, 28
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def session_of(df: DataFrame) -> SparkSession:
    """The session of a frame, with Arrow batches bounded for whole texts; a smaller bound is left as it is."""
    spark = df.sparkSession
    held = spark.conf.get(_BATCH_BYTES).removesuffix("b")
    if not held.isdigit() or int(held) > ARROW_BYTES:
        spark.conf.set(_BATCH_BYTES, str(ARROW_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    return shared_root(spark)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts lineage, survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, folder: str) -> DataFrame:
    """The frame written as Parquet below a folder of the shared one and read again: cuts lineage, and goes with the folder."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_training_row(doc_id: Column) -> Column:
    """Rows that models may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(True))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b if b is not None else b"" for b in pc.cast(column, pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Each text; null counts as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches by rows so that a slice holds about ``most_bytes`` of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for at, n in enumerate(lengths):
            if at > begin and held + n > most_bytes:
                yield batch.slice(begin, at - begin)
                begin, held = at, 0
            held += n
        if begin < len(lengths):
            yield batch.slice(begin)


def bitmap_of(places: DataFrame, bits: int) -> np.ndarray:
    """2 ** bits bits, packed from the lowest on, of which those at the values of ``place`` (from 0) are set; made on the executors."""
    at = F.col("place") + 1
    maps = places.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    held = np.zeros(1 << bits >> 3, np.uint8)
    for r in maps:
        at = (r["bucket"] - 1) * 4096
        held[at : at + 4096] = np.frombuffer(r["bits"], np.uint8)[: len(held) - at]
    return held


def row_key(text: Column) -> Column:
    """SHA-256 of a text's bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))


def _named(rows: DataFrame, docs: DataFrame) -> tuple[DataFrame, Column]:
    """(doc_id, own) rows under names that the documents lack, and the condition that a document is such a row."""
    id_name, key_name, taken = "row_id", "row_key", {c.lower() for c in docs.columns}
    while {id_name, key_name} & taken:
        id_name, key_name = id_name + "_", key_name + "_"
    named = rows.select(F.col("doc_id").alias(id_name), F.col("own").alias(key_name)).distinct()
    return named, docs["doc_id"].cast("long").eqNullSafe(named[id_name]) & (row_key(docs["text"]) == named[key_name])


def key_test(keys: DataFrame) -> Callable[[pa.Array], pa.Array]:
    """A test, for use in tasks: true for each row key among the ``own`` of ``keys``, which should be stored, and for few others.

    A Bloom filter of the four words of each key. Once its bound is reached it lets more through, which the join behind it drops.
    """
    bits = min(FILTER_MOST, max(FILTER_LEAST, (FILTER_SHARE * keys.count()).bit_length()))

    def places(own: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(own.to_pylist()), ">u8").astype(np.uint64) >> np.uint64(64 - bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(places(batch.column("own")).astype(np.int64))], names=["place"])

    held = keys.sparkSession.sparkContext.broadcast(bitmap_of(keys.select("own").mapInArrow(work, "place long"), bits))

    def passes(own: pa.Array) -> pa.Array:
        at = places(own)
        found = held.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)
        return pa.array(found.reshape(-1, 4).all(axis=1))

    return passes


def may_be_among(own: Column, keys: DataFrame) -> Column:
    """``key_test`` as a column; only the keys pass through Python."""
    return F.arrow_udf(key_test(keys), "boolean")(own)


def without_rows(docs: DataFrame, gone: DataFrame, filtered: bool = False) -> DataFrame:
    """The documents that are not among the (doc_id, own) of ``gone``, with all their columns; ``own`` is the row key.

    With ``filtered``, only documents that ``key_test`` lets through are shuffled, for a pass of the keys through Python.
    """
    if not filtered:
        named, match = _named(gone, docs)
        return docs.join(named, match, "left_anti")
    gone = stored(gone.select("doc_id", "own"), f"{shared_dir(docs.sparkSession)}/gone-{uuid.uuid4().hex}")
    named, match = _named(gone, docs)
    maybe = may_be_among(row_key(F.col("text")), gone)
    return docs.where(~maybe).union(docs.where(maybe).join(named, match, "left_anti"))


def one_of_each(docs: DataFrame, gone: DataFrame, repeated: DataFrame, filtered: bool = False) -> DataFrame:
    """The documents without those of ``gone``, and of those of ``repeated`` (none of them gone) one row each.

    Both are (doc_id, own) rows; which of rows with one id and text stays is open.
    """
    if repeated.isEmpty():
        return without_rows(docs, gone, filtered)
    named, match = _named(repeated, docs)
    key, taken = "key", {c.lower() for c in docs.columns}
    while key in taken:
        key += "_"
    ones = docs.join(named, match, "left_semi")
    ones = ones.withColumn(key, F.struct(F.col("doc_id").cast("long"), row_key(F.col("text")))).dropDuplicates([key]).drop(key)
    return without_rows(docs, gone.select("doc_id", "own").unionByName(repeated.select("doc_id", "own")), filtered).unionByName(ones)
