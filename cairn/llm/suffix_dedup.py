"""Removal of repeated substrings by a sparse suffix array built as a distributed merge sort.

A byte goes if a string of ``length`` (400) bytes that covers it starts anywhere
else too. Suffixes are sorted at sampled positions only: each 400-byte window
belongs to the leftmost of the least-hashed 128-byte strings inside it, so equal
windows belong to positions at the same offset, and windows of one position form
a run. Sampling by content loses no repeat; it leaves one suffix in about 140
bytes to sort.

1. Every text gives its sampled positions with the hash of their first 128 bytes.
   Hashes met at two different positions are found by a grouped minimum and
   maximum; only positions that have such a hash go on. A Bloom filter of those
   hashes leaves out most others before they are shuffled.
2. A task sorts the suffixes of its positions, up to 400 bytes each, and writes
   sorted runs, front-coded: the length of the prefix shared with the suffix
   before, and the rest. Runs are exchanged in buckets of the hash, so suffixes
   with the same first 128 bytes meet; there are as many buckets as the number of
   positions asks for.
3. A loser tree merges the runs of a bucket, which are unpacked block by block. A
   suffix carries the length of its common prefix with the last one put out, which
   decides most comparisons; bytes are compared only beyond the prefix known to be
   common.
4. Neighbours' common prefixes to the right, and those of the text to the left of
   the positions, give for each offset the classes of equal windows; a window in a
   class of two or more is repeated. Content is compared, not hashes.

A passage in so many texts that more than ``hot_places`` positions share its first
128 bytes would make one bucket long. Such a group is split by the windows
themselves: equal stretches (the bytes that all windows of a position cover) are
merged by content, windows whose digest no other has are left out, and the rest are
sorted, merged and compared by steps 2 and 3 with the window as the suffix and its
digest as the bucket. A task sends one suffix for all equal windows that it has met,
so a bucket gets no more of a window than there are tasks. A window's position
follows from its content, so every window is judged by exactly one way. Both ways
begin with one pass over the texts, so a first hot gram does not shuffle them again.

Texts that are exact copies are one text to steps 2 to 4, and wholly removed if
they are long enough. Strings are judged on the input. Intermediate tables are
deleted as soon as no later step reads them; those that the result is read from stay.

Defined results: a null text counts as empty; texts shorter than ``length`` are
kept whole; rows repeated with the same id are copies of each other; a null doc_id
is kept as such; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import FILTER_LEAST, FILTER_MOST, FILTER_SHARE, as_bytes, bitmap_of, session_of, shared_dir, slices
from cairn.session import remove_dir

LENGTH = 400
GRAM = 128
#: Places that share a first gram and are still sorted together, and places of a bucket.
HOT_PLACES, BUCKET_PLACES = 50_000, 20_000
_SLICE, _PIECE = 1 << 20, 1 << 20
#: Bits of a place in a slice and the pieces sampled with it: the same for every slice, so that equal texts are sampled alike.
_PLACE_BITS = 24
_RUN_BYTES, _BLOCK_ROWS, _ANALYSE_ROWS = 48 << 20, 256, 20_000
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_EMPTY = hashlib.sha256(b"").hexdigest()


def _text_id(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()[:16]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from running minima of blocks."""
    blocks = np.append(x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def sample(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Sampled positions of texts: (row, position, first window, last window, hash of the gram).

    Long texts are sampled piece by piece; a position whose windows lie in two pieces comes twice, with its windows shared out.
    """
    found, held, size = [], [], 0
    for r, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), _PIECE):
            held.append((r, at, text[at : at + _PIECE + length - 1]))
            size += len(held[-1][2])
            if size >= _PIECE:
                found.append(_sample(held, length, gram))
                held, size = [], 0
    if held:
        found.append(_sample(held, length, gram))
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else tuple(np.zeros(0, np.int64) for _ in range(5))


def _sample(pieces: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``sample`` for pieces (row, where it begins, its bytes)."""
    sizes = np.array([len(p[2]) for p in pieces], np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    n = len(raw)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(up), dtype=np.uint64)])
    hashes = _mix((sums[gram:] - sums[:-gram]) * np.multiply.accumulate(down)[: n - gram + 1])
    bits = np.uint64(_PLACE_BITS)
    keyed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_min(keyed, length - gram + 1)
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(pieces)), sizes)[: len(place)]
    window = np.arange(len(place))
    real = np.flatnonzero(window + length <= (starts + sizes)[owner])
    place, owner = place[real], owner[real]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.append(first[1:], len(real)) - 1
    base = np.array([p[1] for p in pieces], np.int64)[owner[first]] - starts[owner[first]]
    row = np.array([p[0] for p in pieces], np.int64)[owner[first]]
    return row, place[first] + base, real[first] + base, real[last] + base, hashes[place[first]].view(np.int64)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings, of which ``known`` bytes are known to be equal."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def encode_run(suffixes: list[bytes], before: bytes = b"") -> tuple[np.ndarray, np.ndarray, bytes]:
    """Front coding of sorted strings: shared prefix lengths, lengths of the rest, and the rest."""
    shared, rest = [], []
    for s in suffixes:
        p = common_prefix(before, s, 0)
        shared.append(p)
        rest.append(s[p:])
        before = s
    return np.array(shared, np.uint16), np.array(list(map(len, rest)), np.uint16), b"".join(rest)


def decode_run(shared: np.ndarray, sizes: np.ndarray, rest: bytes, before: bytes = b"") -> Iterator[tuple[bytes, int]]:
    """Strings of a run in order, each with its common prefix with the one before."""
    at = 0
    for p, n in zip(shared.tolist(), sizes.tolist(), strict=True):
        before = before[:p] + rest[at : at + n]
        at += n
        yield before, p


def pack_run(rows: list[tuple]) -> bytes:
    """A sorted run of (suffix, *facts) as packed blocks, each front-coded from the end of the one before."""
    pack, blocks, before = zstandard.ZstdCompressor(level=1), [], b""
    for at in range(0, len(rows), _BLOCK_ROWS):
        part = rows[at : at + _BLOCK_ROWS]
        blocks.append(pack.compress(pickle.dumps((encode_run([x[0] for x in part], before), [x[1:] for x in part]))))
        before = part[-1][0]
    return pickle.dumps(blocks)


class PackedRun:
    """Reads a packed run; one block is unpacked at a time. ``facts`` are those of the suffix given out last."""

    def __init__(self, packed: bytes) -> None:
        self.blocks = pickle.loads(packed)
        self.facts: tuple = ()

    def suffixes(self) -> Iterator[tuple[bytes, int]]:
        unpack, suffix = zstandard.ZstdDecompressor(), b""
        for block in self.blocks:
            coded, facts = pickle.loads(unpack.decompress(block))
            for (suffix, shared), self.facts in zip(decode_run(*coded, suffix), facts, strict=True):
                yield suffix, shared


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Loser tree over sorted runs: (run, string, common prefix with the string put out before).

    ``known[k]`` is the common prefix of run k's head with the last string put out;
    the head with the longer one is the smaller, and only heads with equal ones are
    compared, from there on.
    """
    k = len(runs)
    heads, known = [next(r, None) for r in runs], [0] * k
    heads = [h[0] if h else None for h in heads]

    def loses(a: int, b: int) -> bool:
        """Whether a's head comes after b's; sets the known prefix of the loser to that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return x is None
        if known[a] != known[b]:
            return known[a] < known[b]
        p = common_prefix(x, y, known[a])
        after = x[p:] > y[p:] if p < max(len(x), len(y)) else a > b
        known[a if after else b] = p
        return after

    tree, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (b, a) if loses(a, b) else (a, b)
    champion = winners[1] if k > 1 else 0
    while heads[champion] is not None:
        yield champion, heads[champion], known[champion]
        following = next(runs[champion], None)
        heads[champion], known[champion] = following if following else (None, 0)
        node = (champion + k) // 2
        while node:
            if loses(champion, tree[node]):
                champion, tree[node] = tree[node], champion
            node //= 2


def merge_packed(packed: list[bytes]) -> Iterator[tuple[tuple, int]]:
    """(facts, common prefix with the suffix put out before) of all suffixes of packed runs, in order."""
    runs = [PackedRun(p) for p in packed]
    for r, _, prefix in merge_runs([run.suffixes() for run in runs]):
        yield runs[r].facts, prefix


def repeated_offsets(right: np.ndarray, left: list[bytes], low: np.ndarray, high: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Which windows of sorted positions are repeated, by row and offset of the position in the window.

    ``right`` has the common prefix with the suffix before, ``left`` the reversed bytes
    before each position; the windows of a position have offsets low to high.
    """
    n = len(right)
    flags = np.zeros((n, length - gram + 1), bool)
    if n < 2:
        return flags
    group = np.cumsum(right < gram)
    order = np.array(sorted(range(n), key=lambda i: (group[i], left[i])))
    back = np.zeros(n, np.int64)
    for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
        back[b] = common_prefix(left[a], left[b], 0) if group[a] == group[b] else -1
    back[order[0]] = -1
    back_sorted = back[order]
    most_right = np.maximum(right, np.append(right[1:], 0))
    most_left = np.empty(n, np.int64)
    most_left[order] = np.maximum(back_sorted, np.append(back_sorted[1:], -1))
    low, high = np.maximum(low, length - most_right), np.minimum(high, most_left)
    some = np.flatnonzero(low <= high)
    if not len(some):
        return flags
    left_class = np.empty(n, np.int64)
    for offset in range(int(low[some].min()), int(high[some].max()) + 1):
        rows = some[(low[some] <= offset) & (offset <= high[some])]
        if len(rows) < 2:
            continue
        left_class[order] = np.cumsum(back_sorted < offset)
        key = np.cumsum(right < length - offset)[rows] * (n + 1) + left_class[rows]
        by_key = np.argsort(key, kind="stable")
        same = key[by_key[1:]] == key[by_key[:-1]]
        flags[rows[by_key[1:][same]], offset] = True
        flags[rows[by_key[:-1][same]], offset] = True
    return flags


def _store(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _facts(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw = as_bytes(batch.column("text"))
            whole = [hashlib.sha256(t).digest() for t in raw]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([w[:16] for w in whole], pa.binary()), pa.array([len(t) for t in raw], pa.int64()), pa.array([w.hex() for w in whole]),
            ], names=["doc_id", "tid", "n_bytes", "sha256"])

    return docs.mapInArrow(work, "doc_id long, tid binary, n_bytes long, sha256 string")


def _positions(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches, "text", _SLICE):
            texts = {_text_id(t): t for t in as_bytes(batch.column("text")) if len(t) >= length}
            texts = {i: t for i, t in texts.items() if i not in seen}
            if len(seen) < 1_000_000:  # only spares work: copies that are met again are merged later
                seen.update(texts)
            row, place, first, last, hashes = sample(list(texts.values()), length, gram)
            if len(row):
                ids = pa.DictionaryArray.from_arrays(pa.array(row, pa.int64()), pa.array(list(texts), pa.binary())).dictionary_decode()
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (hashes, place, first, last))], names=["tid", "gram", "place", "first", "last"])

    return docs.select("text").mapInArrow(work, "tid binary, gram long, place long, first long, last long")


def _texts(docs: DataFrame) -> DataFrame:
    """Each distinct text once, compressed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text"):
            raw = as_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array([_text_id(t) for t in raw], pa.binary()), pa.array([pack.compress(t) for t in raw], pa.binary())], names=["tid", "packed"])

    return docs.select("text").mapInArrow(work, "tid binary, packed binary").groupBy("tid").agg(F.first("packed").alias("packed"))


def _listed(column: pa.ListArray) -> Iterator[list[np.ndarray]]:
    """The struct fields of each list as arrays."""
    offsets, fields = column.offsets.to_numpy(), [f.to_numpy(zero_copy_only=False) for f in column.values.flatten()]
    for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield [f[a:z] for f in fields]


def _bucket_runs(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Runs of (bucket, suffix, *facts) rows, one for each bucket; the rows are sorted in place."""
    held.sort(key=lambda x: x[:2])
    at, out = 0, []
    while at < len(held):
        end = at
        while end < len(held) and held[end][0] == held[at][0]:
            end += 1
        out.append((held[at][0], pack_run([x[1:] for x in held[at:end]])))
        at = end
    for begin in range(0, len(out), 64):
        chunk = out[begin : begin + 64]
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in chunk], pa.int64()), pa.array([r for _, r in chunk], pa.binary())], names=["bucket", "run"])


_KIND = pa.schema([("tid", pa.binary()), ("digest", pa.binary()), ("content", pa.binary()), ("size", pa.int64()), ("begins", pa.list_(pa.int64()))])
_MADE = "bucket long, run binary, tid binary, digest binary, content binary, size long, begins array<long>"


def _write_runs(length: int, buckets: int):
    """Runs of the places, and the stretches of those whose gram is hot; a row is one or the other."""

    def runs(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        for batch in _bucket_runs(held):
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.nulls(batch.num_rows, f.type) for f in _KIND]], names=["bucket", "run", *_KIND.names])

    def stretches(tid: bytes, text: bytes, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        """The bytes that all windows of a position cover, each distinct one of a text once with its places."""
        found = {}
        for p, q in zip(first.tolist(), last.tolist(), strict=True):
            found.setdefault(text[p : q + length], []).append(p)
        n = len(found)
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array([tid] * n, pa.binary()), pa.array([_text_id(c) for c in found], pa.binary()), pa.array(list(found), pa.binary()),
            pa.array([len(c) for c in found], pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))], names=["bucket", "run", *_KIND.names])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held, size = zstandard.ZstdDecompressor(), [], 0
        for batch in batches:
            for tid, packed, (gram, place, first, last, hot) in zip(batch.column("tid").to_pylist(), batch.column("packed").to_pylist(), _listed(batch.column("places")), strict=True):
                text = unpack.decompress(packed)
                if hot.any():
                    yield stretches(tid, text, first[hot], last[hot])
                for g, m, p, q in zip(*(f[~hot].tolist() for f in (gram, place, first, last)), strict=True):
                    held.append((g % buckets, text[m : q + length], text[p:m][::-1], tid, m, m - q, m - p))
                    size += q + length - p + 200
                    if size > _RUN_BYTES:
                        yield from runs(held)
                        held, size = [], 0
        if held:
            yield from runs(held)

    return write


_SPANS = pa.schema([("tid", pa.binary()), ("begin", pa.int64()), ("end", pa.int64())])


def _by_bucket(merged):
    """Runs that come sorted by bucket, those of each bucket given to ``merged``."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, run in zip(batch.column("bucket").to_pylist(), batch.column("run").to_pylist(), strict=True):
                if b != bucket and held:
                    yield from merged(held)
                    held = []
                bucket = b
                held.append(run)
        if held:
            yield from merged(held)

    return merge


def _merge(length: int, gram: int):
    def spans(rows: list[tuple]) -> pa.RecordBatch:
        """Byte spans covered by repeated windows of whole groups of positions."""
        right, left, tids, places, lows, highs = (list(x) for x in zip(*rows, strict=True))
        flags = repeated_offsets(np.array(right, np.int64), left, np.array(lows, np.int64), np.array(highs, np.int64), length, gram)
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1] - 1
        place = np.array(places, np.int64)[row]
        return pa.RecordBatch.from_arrays([pa.array([tids[r] for r in row.tolist()], pa.binary()), pa.array(place - high), pa.array(place - low + length)], schema=_SPANS)

    def merged(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        held = []
        for facts, prefix in merge_packed(packed):
            if prefix < gram and len(held) >= _ANALYSE_ROWS:
                yield spans(held)
                held = []
            held.append((prefix, *facts))
        if held:
            yield spans(held)

    return _by_bucket(merged)


def _remove(with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for tid, packed, (begin, end) in zip(batch.column("tid").to_pylist(), batch.column("packed").to_pylist(), _listed(batch.column("spans")), strict=True):
                text = unpack.decompress(packed)
                order = np.argsort(begin)
                begin, end = begin[order], np.maximum.accumulate(end[order])
                opens = np.concatenate([[True], begin[1:] > end[:-1]])
                begin, end = begin[opens], end[np.append(np.flatnonzero(opens)[1:] - 1, len(end) - 1)]
                edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(text)]
                kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                rows.append((tid, len(text) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], names=["tid", "n_removed", "n_spans", "kept_sha256", "kept"])

    return remove


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated stretches, those of a row that overlap joined."""
    for batch in batches:
        tids, begins, ends = [], [], []
        for tid, size, places in zip(batch.column("tid").to_pylist(), batch.column("size").to_pylist(), batch.column("begins").to_pylist(), strict=True):
            at = np.sort(np.array(places, np.int64))
            opens = np.concatenate([[True], at[1:] > at[:-1] + size])
            begins.append(at[opens])
            ends.append(at[np.append(opens[1:], True)] + size)
            tids += [tid] * int(opens.sum())
        if tids:
            yield pa.RecordBatch.from_arrays([pa.array(tids, pa.binary()), pa.array(np.concatenate(begins)), pa.array(np.concatenate(ends))], names=["tid", "begin", "end"])


def _windows(length: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest of every window of the given stretches, with where the window and its stretch begin."""
        for batch in batches:
            for tid, begin, content in zip(*(batch.column(c).to_pylist() for c in ("tid", "begin", "content")), strict=True):
                found = [_text_id(content[w : w + length]) for w in range(len(content) - length + 1)]
                n = len(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([tid] * n, pa.binary()), pa.array([begin] * n, pa.int64()), pa.array(np.arange(begin, begin + n)), pa.array(found, pa.binary())], names=["tid", "stretch", "begin", "digest"])

    return windows


def _window_runs(length: int, buckets: int):
    """Windows as sorted runs, each of them once in a run; rows that are met twice in one run are known to be repeated.

    Rows are either a run of a bucket or, with no bucket, a repeated window: its text and begin.
    """
    kinds = pa.schema([("bucket", pa.int64()), ("run", pa.binary()), ("tid", pa.binary()), ("begin", pa.int64())])

    def out(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda x: x[:2])
        rows, known, at = [], [], 0
        while at < len(held):
            end = at + 1
            while end < len(held) and held[end][1] == held[at][1]:
                end += 1
            if end > at + 1:
                known += [(tid, begin) for _, _, tid, begin, asks in held[at:end] if asks]
            rows.append((*held[at][:4], held[at][4] and end == at + 1))
            at = end
        for batch in _bucket_runs(rows):
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], schema=kinds)
        for begin in range(0, len(known), 1 << 16):
            part = known[begin : begin + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.binary()), pa.array([t for t, _ in part], pa.binary()), pa.array([b for _, b in part], pa.int64())], schema=kinds)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for tid, stretch, content, single, begins in zip(*(batch.column(c).to_pylist() for c in ("tid", "stretch", "content", "single", "begins")), strict=True):
                for begin in begins:
                    window = content[begin - stretch : begin - stretch + length]
                    held.append((int.from_bytes(_text_id(window)[:8], "big") % buckets, window, tid, begin, single))
                size += len(begins) * (length + 200)
                if size > _RUN_BYTES:
                    yield from out(held)
                    held, size = [], 0
        if held:
            yield from out(held)

    return write


def _merge_windows(length: int):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        begin = np.array([b for _, b in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.binary()), pa.array(begin), pa.array(begin + length)], schema=_SPANS)

    def merged(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Spans of the windows that another run has too; only those that ask, and each once."""
        out, waiting = [], None
        for (tid, begin, asks), prefix in merge_packed(packed):
            if prefix >= length:
                out += [waiting] * (waiting is not None) + [(tid, begin)] * asks
                waiting = None
            else:
                waiting = (tid, begin) if asks else None
            if len(out) >= 1 << 16:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return _by_bucket(merged)


def _may_have(grams: DataFrame, n: int) -> Column:
    """Whether a place's gram may be among ``n`` stored ones: a Bloom filter, by the low bits of the hash that a gram is.

    Once its bound is reached it lets more through, which the join behind it drops.
    """
    bits = min(FILTER_MOST, max(FILTER_LEAST, (FILTER_SHARE * n).bit_length()))
    least = (1 << bits) - 1
    held = grams.sparkSession.sparkContext.broadcast(bitmap_of(grams.select(F.col("gram").bitwiseAND(F.lit(least)).alias("place")), bits))

    def passes(gram: pa.Array) -> pa.Array:
        at = gram.to_numpy() & least
        return pa.array((held.value[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)).astype(bool))

    return F.arrow_udf(passes, "boolean")(F.col("gram"))


def _by_text(places: DataFrame, grams: DataFrame, n: int, docs: DataFrame) -> DataFrame:
    """Texts with the list of their places that have one of the ``n`` grams (gram, hot)."""
    wanted = places.where(_may_have(grams, n)).join(grams, "gram").groupBy("tid").agg(F.collect_set(F.struct("gram", "place", "first", "last", "hot")).alias("places"))
    return _texts(docs).join(wanted, "tid").select("tid", "packed", "places")


def _merged(runs: DataFrame, places: int, merge) -> DataFrame:
    """Runs exchanged by bucket and merged, in as many tasks as the number of places asks for."""
    least = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(max(least, places // (10 * BUCKET_PLACES)), "bucket").sortWithinPartitions("bucket").mapInArrow(merge, "tid binary, begin long, end long")


def _buckets(spark: SparkSession, places: int) -> int:
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), places // BUCKET_PLACES)


def _hot_spans(stretches: DataFrame, folder: str, length: int) -> DataFrame:
    """Spans of the places whose gram very many share."""
    spark = stretches.sparkSession
    kinds = stretches.groupBy("digest", "content").agg(F.sum(F.size("begins")).alias("n"), F.min(F.struct("tid", F.element_at("begins", 1).alias("begin"))).alias("at"))
    kinds = _store(kinds.select("digest", "content", F.col("at.tid").alias("tid"), F.col("at.begin").alias("begin"), (F.col("n") == 1).alias("single")), folder, "kinds")
    shared = kinds.where("NOT single").select("digest", "content").hint("rebalance")
    whole = stretches.join(shared, ["digest", "content"], "left_semi").select("tid", "size", "begins").mapInArrow(_covered, "tid binary, begin long, end long")

    windows = _store(kinds.select("tid", "begin", "content").mapInArrow(_windows(length), "tid binary, stretch long, begin long, digest binary"), folder, "windows")
    again = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest").hint("rebalance")
    asked = windows.join(again, "digest", "left_semi").groupBy("tid", "stretch").agg(F.collect_list("begin").alias("begins"))
    asked = _store(kinds.withColumnRenamed("begin", "stretch").join(asked, ["tid", "stretch"]).select("tid", "stretch", "content", "single", "begins"), folder, "asked")
    n = asked.agg(F.sum(F.size("begins"))).first()[0] or 0
    runs = _store(asked.mapInArrow(_window_runs(length, _buckets(spark, n)), "bucket long, run binary, tid binary, begin long"), folder, "window_runs")
    known = runs.where("bucket IS NULL").select("tid", "begin", (F.col("begin") + length).alias("end"))
    met = _merged(runs.where("bucket IS NOT NULL").select("bucket", "run"), n, _merge_windows(length))
    return whole.unionByName(known).unionByName(met)


def repeated_spans(docs: DataFrame, folder: str, length: int = LENGTH, gram: int = GRAM, hot_places: int = HOT_PLACES) -> DataFrame:
    """(tid, begin, end) spans of distinct texts that are covered by repeated windows; they may overlap."""
    spark = session_of(docs)
    places = _store(_positions(docs, length, gram), folder, "places")
    at = F.xxhash64("tid", "place")
    grams = _store(places.groupBy("gram").agg(F.min(at).alias("a"), F.max(at).alias("z"), F.count("*").alias("n")).where("a <> z").select("gram", "n"), folder, "grams")
    grams = grams.select("gram", (F.col("n") > hot_places).alias("hot"), "n")
    n = grams.agg(F.sum(F.when(~F.col("hot"), F.col("n"))).alias("plain"), F.count_if("hot").alias("hot"), F.count("*").alias("grams")).first()
    made = _by_text(places, grams.select("gram", "hot"), n["grams"], docs).mapInArrow(_write_runs(length, _buckets(spark, n["plain"] or 0)), _MADE)
    if n["hot"]:
        made = _store(made, folder, "made")
    spans = _merged(made.where("bucket IS NOT NULL").select("bucket", "run"), n["plain"] or 0, _merge(length, gram))
    return spans.unionByName(_hot_spans(made.where("bucket IS NULL").select(*_KIND.names), folder, length)) if n["hot"] else spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = True, hot_places: int = HOT_PLACES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if ``with_text``."""
    if not 8 <= gram < length < 1 << 16:
        raise ValueError("8 <= gram < length < 65536")
    spark = session_of(docs)
    folder = f"{shared_dir(spark)}/suffixes-{uuid.uuid4().hex}"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = _store(_facts(docs), folder, "facts")
    copied = facts.where(F.col("n_bytes") >= length).groupBy("tid").agg(F.count("*").alias("n")).where("n > 1").select("tid")
    spans = _store(repeated_spans(docs, folder, length, gram, hot_places), folder, "spans")
    for name in ("places", "grams", "made", "kinds", "windows", "asked", "window_runs"):
        remove_dir(spark, f"{folder}/{name}")
    by_text = spans.join(copied, "tid", "left_anti").groupBy("tid").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    partly = _texts(docs).join(by_text, "tid").select("tid", "packed", "spans").mapInArrow(_remove(with_text), "tid binary, n_removed long, n_spans long, kept_sha256 string, kept binary")
    wholly = copied.select("tid", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(_EMPTY).alias("kept_sha256"), F.lit("").cast("binary").alias("kept"))
    changed = partly.unionByName(wholly).hint("rebalance")  # one row a text, so that a hot text can be split in the join
    out = facts.join(changed, "tid", "left").select(
        "doc_id", "n_bytes", F.when(F.col("n_spans").isNull(), 0).otherwise(F.coalesce("n_removed", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), *(["kept", "tid"] if with_text else []))
    if not with_text:
        return out
    untouched = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("raw")).withColumn("tid", F.unhex(F.substring(F.sha2("raw", 256), 1, 32))).dropDuplicates(["tid"])
    return out.join(untouched, "tid", "left").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.coalesce("kept", "raw").alias("kept"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLES: dict[str, str] = {}
