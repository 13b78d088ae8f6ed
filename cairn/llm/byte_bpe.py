"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A text is cut where the pre-tokenizer must cut too: before each single space.
Only segments not met before are handed to the library, in one batch call; the
ids of a text are the joined ids of its segments. Where a run of white space
would make that cut differ from the pattern's (a space between white space, or
at the end after white space), the text is cut by the pattern itself.

Each id stands for bytes, not characters: the vocabulary writes bytes as
printable characters, decoding reverses that table, and a character may be split
over ids, so only the joined bytes are decoded to text. ``encode`` also gives
each token's first byte and first character; a token that starts inside a
character gets that character.

Defined results: a null text is encoded as empty and gives no ids; special
tokens in a text are ordinary text; repeated rows are encoded each; an empty
table gives no rows; invalid UTF-8 is replaced before encoding.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, session_of, slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Segments whose ids a worker remembers, and their longest; a bound on memory that results do not depend on.
REMEMBERED, REMEMBERED_CHARS = 300_000, 32
_UNSAFE = re.compile(r"\s \s|\s \Z")


def byte_table() -> dict[str, int]:
    """Printable stand-in of each byte: itself where it is printable, else the next free character from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, vocabulary: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        table = byte_table()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.bytes_of = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = token.encode() if token in special else bytes(table[c] for c in token)
        self.known: dict[str, bytes] = {}

    def segments(self, text: str) -> list[str]:
        if _UNSAFE.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.segments(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, others = self.known, {}
        new = list(set().union(*cut).difference(known))
        for begin in range(0, len(new), 20_000):
            part = new[begin : begin + 20_000]
            for segment, found in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                (known if len(segment) <= REMEMBERED_CHARS else others)[segment] = array("I", found.ids).tobytes()
        find = (lambda s: known[s] if s in known else others[s]) if others else known.__getitem__
        return [b"".join(map(find, segments)) for segments in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def starts(self, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First byte and first character of each token."""
        pieces = [self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()]
        ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        first = np.concatenate([np.zeros(min(1, len(ends)), np.int64), ends[:-1]])
        begins = (np.frombuffer(b"".join(pieces), np.uint8) & 0xC0) != 0x80
        return first, np.cumsum(begins)[first] - 1 if len(first) else first


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [raw.decode("utf-8", "replace") for raw in as_bytes(batch.column("text"))]


def _keyed(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), column)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids, and for each id its first byte and first character in the text."""
    session_of(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in slices(batches, "text", 2 << 20):
            ids = tool.encode(_texts(batch))
            starts = [tool.starts(x) for x in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())),
                pa.array([s[0] for s in starts], pa.list_(pa.int64())), pa.array([s[1] for s in starts], pa.list_(pa.int64())),
            ], names=["doc_id", "ids", "byte_starts", "char_starts"])

    return _keyed(docs, "text").mapInArrow(work, "doc_id long, ids array<int>, byte_starts array<long>, char_starts array<long>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and the text of (doc_id, ids); bytes that are not UTF-8 are shown as the replacement character."""
    session_of(encoded)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in batches:
            raw = [tool.decode(np.array(x if x is not None else [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())], names=["doc_id", "text"])

    return _keyed(encoded, "ids").mapInArrow(work, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes that they decode to."""
    session_of(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in slices(batches, "text", 2 << 20):
            ids = tool.encode(_texts(batch))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(tool.decode(x)).hexdigest() for x in ids]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _keyed(docs, "text").mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
ORACLES: dict[str, str] = {}
