"""Exact dedup by Grace hash: spilled partitions, open-addressing tables, whole contents.

Each input partition first merges its own copies, so that a content held by a
third of all rows leaves a partition once. The survivors are shuffled by the
digest of the content; each shuffle partition is deduplicated in a table that
compares complete contents, and where the table would outgrow its budget the
records are split by further digest bits into spill files, recursively. Only
the small class rows (digest, kept id, size) are joined back to the documents;
that join has one row per class on one side, so the skew-join rule can split a
hot class on the other.

Defined results: a null text counts as empty; rows whose texts are equal after
removing ASCII white space form one class, however many; a null doc_id sorts
after every other; rows repeated with the same doc_id and text carry the same
verdict; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, cut, one_of_each, session_of, slices

WHITE = b" \t\n\x0b\x0c\r"
#: Bytes of content that a table may hold before it is split.
TABLE_BYTES = 32 << 20
FANOUT = 16


class OpenTable:
    """Open addressing with linear probing; a slot matches only if the whole content does.

    An entry is [digest, content, most code points, doc_id, rows] and, if given, the key of the text that
    breaks ties of one doc_id, and the number of rows with that doc_id and text.
    """

    def __init__(self) -> None:
        self.slots: list[list | None] = [None] * 1024
        self.used = 0
        self.bytes = 0

    def _find(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (entry := self.slots[at]) is not None and not (entry[0] == digest and entry[1] == content):
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        entries = list(self)
        self.slots = [None] * (2 * len(self.slots))
        for entry in entries:
            self.slots[self._find(entry[0], entry[1])] = entry

    def add(self, record: list) -> None:
        digest, content, points, doc_id, rows, *rest = record
        at = self._find(digest, content)
        entry = self.slots[at]
        if entry is None:
            self.slots[at] = list(record)
            self.used += 1
            self.bytes += len(content) + 200
            if 3 * self.used > 2 * len(self.slots):
                self._grow()
            return
        entry[4] += rows
        mine, held = (-points, doc_id is None, doc_id or 0, rest[:1]), (-entry[2], entry[3] is None, entry[3] or 0, entry[5:6])
        if mine < held:
            entry[2], entry[3], entry[5:] = points, doc_id, rest
        elif mine == held and rest:
            entry[6] += rest[1]

    def __iter__(self) -> Iterator[list]:
        return (entry for entry in self.slots if entry is not None)


def grace(records: Iterable[list], budget: int, folder: str, level: int = 0) -> Iterator[list]:
    """One merged entry per content, in bounded memory."""
    table, files = OpenTable(), []
    try:
        for record in records:
            if files:
                pickle.dump(record, files[_part(record[0], level)])
                continue
            table.add(record)
            if table.bytes > budget and table.used > 1 and level < 32:
                files = [open(os.path.join(folder, f"{level}-{k}"), "wb") for k in range(FANOUT)]
                for entry in table:
                    pickle.dump(entry, files[_part(entry[0], level)])
                table = OpenTable()
    finally:
        for file in files:
            file.close()
    if not files:
        yield from table
        return
    for k, file in enumerate(files):
        inner = os.path.join(folder, f"d{level}-{k}")
        os.mkdir(inner)
        yield from grace(_spilled(file.name), budget, inner, level + 1)
        shutil.rmtree(inner)
        os.remove(file.name)


def _part(digest: bytes, level: int) -> int:
    return digest[level] & (FANOUT - 1)


def _spilled(path: str) -> Iterator[list]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for batch in slices(batches, "text"):
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
            content = raw.translate(None, WHITE)
            yield [hashlib.sha256(content).digest(), content, len(raw.decode("utf-8", "replace")), doc_id, 1, hashlib.sha256(raw).digest(), 1]


_RECORD = "digest binary, content binary, points long, doc_id long, n long, own binary, same long"
_CLASS = "text_sha256 string, keep_id long, group_size long, keep_own binary, keep_same long"


def _arrow(schema: pa.Schema, rows: Iterable[list], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) if isinstance(row[1], bytes) else 100
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_RECORD_PA = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("points", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("own", pa.binary()), ("same", pa.int64())])
_CLASS_PA = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("keep_own", pa.binary()), ("keep_same", pa.int64())])


def classes(docs: DataFrame, budget: int = TABLE_BYTES) -> DataFrame:
    """One row per class of equal texts: text_sha256, keep_id, group_size, keep_own (the key of the kept text) and
    keep_same (the number of rows with the kept id and text)."""
    session_of(docs)

    def merge_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> Iterator[list]:
            table = OpenTable()
            for record in _records(batches):
                table.add(record)
                if table.bytes > budget:
                    yield from table
                    table = OpenTable()
            yield from table

        yield from _arrow(_RECORD_PA, merged())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def received() -> Iterator[list]:
            for batch in slices(batches, "content"):
                yield from map(list, zip(*(c.to_pylist() for c in batch.columns), strict=True))

        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            entries = grace(received(), budget, folder)
            yield from _arrow(_CLASS_PA, ([e[0].hex(), e[3], e[4], e[5], e[6]] for e in entries))

    local = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(merge_locally, _RECORD)
    return local.repartition("digest").mapInArrow(merge, _CLASS)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256 (of the text without ASCII white space) and own (the key of the text as it is) of each row."""
    session_of(docs)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raws = as_bytes(batch.column("text"))
            found = [hashlib.sha256(raw.translate(None, WHITE)).hexdigest() for raw in raws]
            own = [hashlib.sha256(raw).digest() for raw in raws]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string()), pa.array(own, pa.binary())], names=["doc_id", "text_sha256", "own"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(digest, "doc_id long, text_sha256 string, own binary")


def exact_dedup(docs: DataFrame, budget: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    repeated = classes(docs, budget).where("group_size > 1")
    joined = digests(docs).join(repeated, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def keep_one(docs: DataFrame, budget: int = TABLE_BYTES) -> DataFrame:
    """The documents that stay, with all their columns: one row of each class, with the most code points, then the
    smallest (doc_id, key of the text), a null doc_id after all others; of rows with one doc_id and text any one."""
    repeated = cut(classes(docs, budget).where("group_size > 1"))
    gone = digests(docs).join(repeated, "text_sha256").where("NOT (doc_id <=> keep_id AND own = keep_own)")
    return one_of_each(docs, gone, repeated.where("keep_same > 1").select(F.col("keep_id").alias("doc_id"), F.col("keep_own").alias("own")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS c FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY c) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER w AS kept,
       sha256(c) AS text_sha256
FROM d WINDOW w AS (PARTITION BY c ORDER BY length(t) DESC, doc_id NULLS LAST)
"""

QUERIES = {"op10_exact_dedup": op10_exact_dedup}
ORACLES = {"op10_exact_dedup": OP10_SQL}
