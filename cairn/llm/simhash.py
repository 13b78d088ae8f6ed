"""SimHash near-dedup over anchor points of a covering code.

Fingerprints at 3 or fewer differing bits differ in at most one bit within the
low or the high half of the word. In 31 bits of each half the perfect Hamming
code is the set of anchors: its covering radius is 1, so every fingerprint is
within 1 of an anchor, and a partner that differs there by at most 1 is within
2 of the same anchor. Each distinct fingerprint is therefore replicated to every
anchor within covering radius plus threshold (1 or 16 of 2**26 per half) and
compared, on all 64 bits, with the others at that anchor. No link is lost; no
bucket is capped.

Copies share a fingerprint and are merged before replication, so hot groups of
copies cost one row. At an anchor links are folded at once into stars, so what
leaves a task grows with the fingerprints and not with their pairs. An anchor with
more than ``ANCHOR_ROWS`` different fingerprints is cut into blocks, and each pair
of blocks is compared in a group of its own, so no task gets it whole.

Defined results: a null or word-less text has fingerprint zero and is linked
like any other; repeated rows get the same row each; a null doc_id never names a
component unless all of the component are null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, cut, one_of_each, session_of, shared_dir, slices, stored
from cairn.llm.components import components

SHINGLE_WORDS = 3
MOST_BITS = 3
SEED = 42
#: Rows of an anchor that are compared in one group; a larger one is cut into pairs of blocks.
ANCHOR_ROWS = 1 << 15
_PIECE = 1 << 20
_WHITE = b" \t\n\x0b\x0c\r"


def _word_runs(text: bytes, carry: int) -> Iterator[list[bytes]]:
    """Words of a text in runs of bounded bytes; each run repeats the last ``carry`` words before it."""
    if len(text) <= _PIECE:
        yield text.split()
        return
    kept: list[bytes] = []
    begin, short = 0, True
    while begin < len(text):
        end = min(len(text), begin + _PIECE)
        while end < len(text) and text[end] not in _WHITE:
            end += 1
        words = kept + text[begin:end].split()
        begin = end
        if len(words) > carry:
            yield words
            kept, short = words[-carry:] if carry else [], False
        else:
            kept = words
    if short:
        yield kept


def _shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    return np.array([digest(joined[a:z], SEED) for a, z in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64)


def _add_bits(ones: np.ndarray, hashes: np.ndarray) -> None:
    """Add how often each bit is set."""
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _word_of(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]) if n else 0


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    _add_bits(ones, hashes)
    return _word_of(ones, len(hashes))


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, as an unsigned integer."""
    ones, n = np.zeros(64, np.int64), 0
    for words in _word_runs(text.lower(), width - 1):
        hashes = _shingle_hashes(words, width)
        _add_bits(ones, hashes)
        n += len(hashes)
    return _word_of(ones, n)


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, own (the key of the text) and fp (the fingerprint's bits as a long) of each row."""
    session_of(docs)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raws = as_bytes(batch.column("text"))
            found = np.array([fingerprint(raw, width) for raw in raws], np.uint64)
            own = pa.array([hashlib.sha256(raw).digest() for raw in raws], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), own, pa.array(found.view(np.int64))], names=["doc_id", "own", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of_batches, "doc_id long, own binary, fp long")


def _flips() -> np.ndarray:
    """By syndrome: the bit flips that lead to each anchor within 2 of a 31-bit word; row 0 has one."""
    bit = lambda k: 1 << (k - 1)
    rows = [[0] * 16]
    for s in range(1, 32):
        rows.append([bit(s)] + [bit(i) | bit(i ^ s) for i in range(1, 32) if i != s and i < i ^ s])
    return np.array(rows, np.int64)


_FLIPS = _flips()
_PARITY = [sum(1 << (k - 1) for k in range(1, 32) if k >> b & 1) for b in range(5)]


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every anchor within 2 of each 31-bit word: (row of the word, anchor)."""
    syndrome = np.zeros(len(values), np.int64)
    for b, mask in enumerate(_PARITY):
        syndrome |= (np.bitwise_count(values & mask).astype(np.int64) & 1) << b
    found = values[:, None] ^ _FLIPS[syndrome]
    wanted = np.ones(found.shape, bool)
    wanted[syndrome == 0, 1:] = False
    rows = np.nonzero(wanted)[0]
    return rows, found[wanted]


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for half in (0, 1):
            rows, anchor = anchors((fps.view(np.uint64) >> np.uint64(32 * half)).astype(np.int64) & 0x7FFFFFFF)
            yield pa.RecordBatch.from_arrays([pa.array(anchor | half << 31), pa.array(fps[rows])], names=["anchor", "fp"])


def _fold(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make the labels of linked rows equal to the least of their component, in place."""
    while True:
        least = np.minimum(label[a], label[b])
        if np.array_equal(label[a], least) and np.array_equal(label[b], least):
            return
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while not np.array_equal(further := label[label], label):
            label[:] = further


def _stars(anchor: np.ndarray, fps: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of the same anchor, as stars around one of each component."""
    label = np.arange(len(fps))
    bits = fps.view(np.uint64)
    at, step, held, count = np.arange(len(fps)), 1, [], 0
    while True:
        at = at[at + step < len(fps)]
        at = at[anchor[at] == anchor[at + step]]
        if not len(at):
            break
        near = at[np.bitwise_count(bits[at] ^ bits[at + step]) <= most_bits]
        if len(near):
            held.append((near, near + step))
            count += len(near)
        if count > 1 << 20:
            _fold(label, *map(np.concatenate, zip(*held, strict=True)))
            held, count = [], 0
        step += 1
    if held:
        _fold(label, *map(np.concatenate, zip(*held, strict=True)))
    leaves = np.nonzero(label != np.arange(len(fps)))[0]
    return fps[leaves], fps[label[leaves]]


def _compare(most_bits: int, limit: int | None):
    """Links of rows that come sorted by anchor, as (u, v); with a limit the rows of a larger group are
    passed on as (anchor, fp) under ``later`` instead of being compared."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(u: np.ndarray, v: np.ndarray, later: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(u), later)), pa.array(u), pa.array(v)], names=["later", "u", "v"])

        step = min(1 << 15, limit or 1 << 15)
        anchor, fps, hot = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            anchor = np.concatenate([anchor, batch.column("anchor").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy()])
            if hot is not None:
                end = int(np.searchsorted(anchor, hot, "right"))
                yield out(anchor[:end], fps[:end], True)
                anchor, fps = anchor[end:], fps[end:]
            if len(fps) < step:
                continue
            whole = int(np.searchsorted(anchor, anchor[-1]))
            if whole:
                yield out(*_stars(anchor[:whole], fps[:whole], most_bits), False)
                anchor, fps = anchor[whole:], fps[whole:]
            if limit and len(fps) > limit:
                hot = int(anchor[0])
                yield out(anchor, fps, True)
                anchor, fps = anchor[:0], fps[:0]
        if len(fps):
            yield out(*_stars(anchor, fps, most_bits), False)

    return compare


def _links(rows: DataFrame, most_bits: int, limit: int | None) -> DataFrame:
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare(most_bits, limit), "later boolean, u long, v long")


def _in_blocks(rows: DataFrame, limit: int) -> DataFrame:
    """Groups cut into blocks of about half the limit; each pair of blocks is a group of its own."""
    counts = rows.groupBy("anchor").agg(F.ceil(F.count("*") * 2 / limit).alias("blocks")).hint("rebalance")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    dealt = rows.join(counts, "anchor").select("anchor", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    return dealt.select(F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other")).alias("anchor"), "fp")


def near_links(fps: DataFrame, most_bits: int = MOST_BITS, limit: int = ANCHOR_ROWS, folder: str | None = None) -> DataFrame:
    """Distinct fp rows to (u, v) links, as stars that join all fingerprints linked at an anchor."""
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError("the anchors cover links of at most 3 differing bits")
    found = stored(_links(fps.select("fp").mapInArrow(_replicate, "anchor long, fp long"), most_bits, limit), folder or shared_dir(fps.sparkSession))
    links, later = found.where("NOT later").select("u", "v"), found.where("later").select(F.col("u").alias("anchor"), F.col("v").alias("fp"))
    if not later.isEmpty():
        links = links.unionByName(_links(_in_blocks(later, limit), most_bits, None).select("u", "v"))
    return links


def near_components(prints: DataFrame, most_bits: int = MOST_BITS, limit: int = ANCHOR_ROWS) -> DataFrame:
    """(doc_id, fp) rows to (fp, root, component_id), one per distinct fingerprint; the root is a fingerprint of the component."""
    session_of(prints)
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(near_links(distinct, most_bits, limit))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id")).hint("rebalance")
    return rooted.join(least, "root").select("fp", "root", "component_id")


def simhash_dedup(docs: DataFrame, width: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id."""
    prints = cut(fingerprints(docs, width))
    return prints.join(near_components(prints, most_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """The documents that stay, with all their columns: of each component the row with the smallest (doc_id, key of
    the text), a null doc_id after all others; of rows with one doc_id and text any one."""
    prints = cut(fingerprints(docs, width))
    rows = cut(prints.join(near_components(prints, most_bits), "fp").groupBy("root", "doc_id", "own").agg(F.count("*").alias("n")))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "own")).alias("stays")).hint("rebalance")
    judged = rows.join(first, "root").withColumn("stay", F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("own") == F.col("stays.own")))
    return one_of_each(docs, judged.where("NOT stay"), judged.where("stay AND n > 1"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op7_simhash_dedup": op7_simhash_dedup}
ORACLES: dict[str, str] = {}
