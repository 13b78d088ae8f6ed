"""Benchmark decontamination by spaced seeds.

A seed hashes the words that a fixed mask selects, so a substituted word at an
ignored position does not hide it. The two masks together hit every stretch of
13 words in which at most 2 are substituted (checked over all placements in the
tests), which is the overlap looked for: 13 aligned words of a benchmark item,
at least 0.8 of them equal. An item of fewer words is looked for whole, by masks
over all of it that meet every placement of a fifth of its words substituted.

The documents are read once: a task works out the seeds of their words, and keeps
those that a Bloom filter over the benchmark's seeds lets through (of bounded size,
whatever the benchmark's; a fuller one lets through more, and loses none), with the word hashes of the few documents that have
any. These are joined with the seeds of the benchmark; a hit gives an alignment, and
the item is compared with the document along it, word by word. In the joins the
skew-join rule may split a seed that very many documents have.

Words are runs of ASCII letters, digits and non-ASCII characters, in lower case.
Defined results: a null text or id of a document is handled like any other (a
null text has no words and no overlap); items without words match nothing;
repeated documents or items give a row each; an empty table gives no rows. In the
filtering stage items of fewer than ``LEAST_WORDS`` words taint no document: such
runs of words occur in clean texts.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, bitmap_of, session_of, shared_dir, slices, without_rows

MASKS = ("11101011", "11001111")
OVERLAP_WORDS = 13
SIMILARITY = 0.8
#: Words of an item from which on it taints documents in the filtering stage.
LEAST_WORDS = 8
#: Bits of the Bloom filter for each of the benchmark's seeds, places of a seed in it, and powers of two that bound its size.
FILTER_SHARE, FILTER_PLACES, FILTER_LEAST, FILTER_MOST = 64, 4, 20, 28
_SLICE = 1 << 20
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2**64."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(row, bytes) of the texts in lower case, long ones cut between words."""
    for r, text in enumerate(texts):
        low = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()
        at = 0
        while at < len(low):
            end = min(len(low), at + _SLICE)
            while end < len(low) and _IS_WORD[low[end]]:
                end += 1
            yield r, low[at:end]
            at = end


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts, in order, and the row of its text."""
    hashes, rows, held, size = [], [], [], 0

    def flush() -> None:
        raw = np.frombuffer(b" ".join(p for _, p in held) + b" ", np.uint8)
        edges = np.flatnonzero(np.diff(_IS_WORD[raw].view(np.int8), prepend=0))
        begins, ends = edges[::2], edges[1::2]
        up, down = _powers(1 << (max(len(raw), 2 * _SLICE) - 1).bit_length())
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], dtype=np.uint64)])
        hashes.append(_mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64)))
        piece = np.searchsorted(np.cumsum([len(p) + 1 for _, p in held]), begins, side="right")
        rows.append(np.array([r for r, _ in held], np.int64)[piece])

    for r, piece in _pieces(texts):
        held.append((r, piece))
        size += len(piece)
        if size >= _SLICE:
            flush()
            held, size = [], 0
    if held:
        flush()
    return (np.concatenate(hashes), np.concatenate(rows)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Seed at each position where the mask fits."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, int("1" + mask, 2), np.uint64)
    for at, bit in enumerate(mask):
        if bit == "1":
            total = total * np.uint64(_BASE) + hashes[at : at + n]
    return _mix(total)


def short_masks(words: int, similarity: float = SIMILARITY) -> list[str]:
    """Masks over a whole item of few words, of which every permitted placement of substitutions leaves one untouched.

    The words are cut into two blocks more than may be substituted; each mask ignores as many blocks as words may be.
    """
    changed = words - int(np.ceil(similarity * words - 1e-9))
    blocks = [len(b) for b in np.array_split(np.arange(words), min(words, changed + 2))]
    return ["".join(("0" if k in gone else "1") * n for k, n in enumerate(blocks)) for gone in combinations(range(len(blocks)), changed)]


def masks_of(words: int, overlap: int = OVERLAP_WORDS, similarity: float = SIMILARITY) -> list[str]:
    """The masks by which an item of so many words is looked for."""
    return list(MASKS) if words >= overlap else short_masks(words, similarity) if words else []


def best_overlap(text: np.ndarray, item: np.ndarray, shifts: list[int], overlap: int, similarity: float) -> tuple[int, int, int, int] | None:
    """(equal words, first word in the text, in the item, words) of the best aligned part, if some stretch is similar enough."""
    best, width = None, min(overlap, len(item))
    for shift in shifts:
        first, last = max(0, -shift), min(len(item), len(text) - shift)
        if last - first < width:
            continue
        sums = np.concatenate([[0], np.cumsum(text[first + shift : last + shift] == item[first:last])])
        good = np.flatnonzero(sums[width:] - sums[:-width] >= np.ceil(similarity * width - 1e-9))
        if len(good):
            begin, end = int(good[0]), int(good[-1]) + width
            found = (int(sums[end] - sums[begin]), begin + first + shift, begin + first, end - begin)
            best = max(best or found, found)
    return best


def _items(benchmark: DataFrame, least_words: int, folder: str) -> DataFrame:
    """(item, item_id, words): a row for each item of enough words, stored, with the hashes of its words."""
    kinds = pa.schema([("item_id", pa.int64()), ("words", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch.column("item_id").to_pylist()
            hashes, row = word_hashes(as_bytes(batch.column("text")))
            ends = np.cumsum(np.bincount(row, minlength=len(ids)))
            words = [hashes[a:z] for a, z in zip([0, *ends[:-1]], ends, strict=True)]
            rows = [(i, w.tobytes()) for i, w in zip(ids, words, strict=True) if len(w) >= max(1, least_words)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(work, "item_id long, words binary")
    rows.withColumn("item", F.monotonically_increasing_id()).write.parquet(f"{folder}/items")
    return benchmark.sparkSession.read.parquet(f"{folder}/items")


def _item_seeds(items: DataFrame, overlap: int, similarity: float, folder: str) -> DataFrame:
    """(seed, item, at), stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist(), strict=True):
                words = np.frombuffer(raw, np.uint64)
                for mask in masks_of(len(words), overlap, similarity):
                    found = seeds(words, mask)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), item)), pa.array(np.arange(len(found)))], names=["seed", "item", "at"])

    items.select("item", "words").mapInArrow(work, "seed long, item long, at long").write.parquet(f"{folder}/seeds")
    return items.sparkSession.read.parquet(f"{folder}/seeds")


def _place(seed: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th place of each seed in a filter of 2 ** bits."""
    return _mix(seed + np.uint64((k + 1) * _INVERSE % (1 << 64))) >> np.uint64(64 - bits)


def _filter(item_seeds: DataFrame) -> tuple[int, Broadcast]:
    """(power of two, bitmap) of a Bloom filter over all seeds: at most 2 ** FILTER_MOST bits, made on the executors."""
    bits = min(FILTER_MOST, max(FILTER_LEAST, (FILTER_SHARE * item_seeds.count()).bit_length()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed = batch.column("seed").to_numpy().astype(np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_place(seed, k, bits) for k in range(FILTER_PLACES)]).astype(np.int64))], names=["place"])

    held = bitmap_of(item_seeds.select("seed").mapInArrow(work, "place long"), bits)
    return bits, item_seeds.sparkSession.sparkContext.broadcast(held)


def _candidates(docs: DataFrame, masks: list[str], bits: int, held: Broadcast, folder: str) -> DataFrame:
    """(row, doc_id, own, words, seeds, places) of the documents of which a seed passes the filter, stored."""
    kinds = pa.schema([("doc_id", pa.int64()), ("own", pa.binary()), ("words", pa.binary()), ("seeds", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = held.value
        for batch in slices(batches, "text", _SLICE):
            texts = as_bytes(batch.column("text"))
            hashes, row = word_hashes(texts)
            size = np.bincount(row, minlength=len(texts))
            start = np.cumsum(size) - size
            passed, places = [], []
            for mask in masks:
                own = seeds(hashes, mask)
                maybe = np.arange(len(own))
                for k in range(FILTER_PLACES):
                    slot = _place(own[maybe], k, bits)
                    maybe = maybe[(bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & np.uint8(1)) > 0]
                maybe = maybe[row[maybe] == row[maybe + len(mask) - 1]]
                passed.append(own[maybe])
                places.append(maybe)
            passed, places = np.concatenate(passed).view(np.int64), np.concatenate(places)
            order = np.argsort(places, kind="stable")
            passed, places = passed[order], places[order]
            ids, out = batch.column("doc_id").to_pylist(), []
            owner = row[places]
            for r in np.unique(owner).tolist():
                a, z = np.searchsorted(owner, [r, r + 1])
                out.append((ids[r], hashlib.sha256(texts[r]).digest(), hashes[start[r] : start[r] + size[r]].tobytes(), passed[a:z], places[a:z] - start[r]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, own binary, words binary, seeds array<long>, places array<long>")
    found.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/candidates")
    return docs.sparkSession.read.parquet(f"{folder}/candidates")


def _verify(overlap: int, similarity: float):
    kinds = pa.schema([("doc_id", pa.int64()), ("own", pa.binary()), *((n, pa.int64()) for n in ("item_id", "first_word", "item_word", "words", "equal_words"))])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, own, text, item_id, item, shifts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "own", "words", "item_id", "item_words", "shifts")), strict=True):
                if best := best_overlap(np.frombuffer(text, np.uint64), np.frombuffer(item, np.uint64), shifts, overlap, similarity):
                    rows.append((doc_id, own, item_id, best[1], best[2], best[3], best[0]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    return verify


def _overlaps(docs: DataFrame, benchmark: DataFrame, overlap: int, similarity: float, least_words: int) -> DataFrame:
    """``overlaps`` with the key of the document's text as ``own``."""
    spark = session_of(docs)
    folder = f"{shared_dir(spark)}/decontaminate-{uuid.uuid4().hex}"
    items = _items(benchmark, least_words, folder)
    item_seeds = _item_seeds(items, overlap, similarity, folder)
    sizes = [r[0] for r in items.select(F.least(F.octet_length("words") / 8, F.lit(overlap)).cast("int")).distinct().collect()]  # at most ``overlap`` values
    masks = sorted({m for n in sizes for m in masks_of(n, overlap, similarity)})
    if not masks:
        return spark.createDataFrame([], "doc_id long, own binary, item_id long, first_word long, item_word long, words long, equal_words long")
    candidates = _candidates(docs, masks, *_filter(item_seeds), folder)
    met = candidates.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("row", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    hits = met.join(item_seeds, "seed").groupBy("row", "item").agg(F.collect_set(F.col("place") - F.col("at")).alias("shifts"))
    pairs = hits.join(items.select("item", "item_id", F.col("words").alias("item_words")), "item").join(candidates.select("row", "doc_id", "own", "words"), "row")
    return pairs.select("doc_id", "own", "words", "item_id", "item_words", "shifts").mapInArrow(
        _verify(overlap, similarity), "doc_id long, own binary, item_id long, first_word long, item_word long, words long, equal_words long")


def overlaps(docs: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and item that overlap: where, over how many words, and how many are equal."""
    return _overlaps(docs, benchmark, overlap, similarity, 1).drop("own")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP_WORDS, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents that overlap with no item of at least ``least_words`` words, with all their columns."""
    return without_rows(docs, _overlaps(docs, benchmark, overlap, similarity, least_words).select("doc_id", "own"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op9_decontaminate": op9_decontaminate}
ORACLES: dict[str, str] = {}
