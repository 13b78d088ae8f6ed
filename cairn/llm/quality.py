"""Quality scores: random-indexing word vectors pooled per document, a small network, calibrated by a temperature.

A text is a stream of runs of bytes: words (letters, digits, bytes beyond ASCII, single ' and -
between them), with ASCII letters in lower case, and runs of other marks; a word in capitals
and one that repeats the word before carry a mark of their own. Each is one of ``BUCKETS`` by a hash, so every word counts and the vectors have a fixed
size. A bucket has a sparse index vector of ones and minus ones, from a fixed seed. Its
context vector is the sum of the index vectors within ``WINDOW`` places of it, over all
documents: tasks add up their own, Spark adds those up. Its word vector is its context's
direction, less that of the mean, with its own index vector, weighted down where it is
frequent. A document is the mean and the deviation of its words' vectors, and its length.

A two-layer network is fitted in numpy on a sample of about ``FIT_ROWS`` labelled rows
whose crc32 of doc_id is not 0 modulo 5; a fifth of the sample, by a hash of doc_id, is
left out and sets the temperature that its scores are divided by.

Defined results: a null text counts as empty and is scored like any other; rows labelled
twice count with the higher label, null labels not at all; of documents with one doc_id
one is learned from; without labels of both kinds every score is the share of label 1 (0.5
if there are none); repeated rows are scored each; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, session_of, slices

#: Buckets (0 is none), components of a vector, non-zero ones of an index vector, places to either side.
BUCKET_BITS, DIM, NONZERO, WINDOW = 16, 32, 4, 2
BUCKETS = 1 << BUCKET_BITS
#: Share of all tokens at which a word counts a half (by the root), and the weight of its own index vector.
FREQUENT, OWN = 1e-3, 0.5
FIT_ROWS = 20_000
HIDDEN, EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY, SEED = 32, 20, 600, 64, 3e-3, 1e-4, 11
THRESHOLD = 0.3
FEATURES = 2 * DIM + 1
#: Tokens, and bytes of texts, that are handled together. Results do not depend on them.
TOKENS, PIECE = 1 << 16, 1 << 20
_WHITE, _WORD, _MARK = 0, 1, 2
_BYTES = np.arange(256)
_UPPER, _LOWER = (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122)
_KIND = np.where(np.isin(_BYTES, list(b" \t\n\x0b\x0c\r")), _WHITE, np.where(_UPPER | _LOWER | (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)), _WORD, _MARK)).astype(np.uint8)
_FOLDED = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint64) + np.uint64(1)
_JOINS = np.isin(_BYTES, list(b"'-"))
#: Odd factors of the hash of a run of bytes.
_FACTOR, _MIX, _OF_KIND = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor up to those of a piece, and of its inverse modulo 2 ** 64."""
    out = []
    for factor in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        each = np.full(PIECE + 1, factor, np.uint64)
        each[0] = 1
        out.append(np.cumprod(each))
    return out[0], out[1]


def _buckets(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(32))) * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(BUCKETS - 1) + np.uint64(1)).astype(np.uint16)


_CAPITALS, _AGAIN = _buckets(np.array([1, 2], np.uint64) * _OF_KIND)


def _runs(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, kind and hash of each word and each run of marks in at most ``PIECE`` bytes, and whether it is in capitals."""
    kind = _KIND[raw]
    inner = _JOINS[raw[1:-1]] & (kind[:-2] == _WORD) & (kind[2:] == _WORD)
    kind[1:-1][inner] = _WORD
    begin = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    powers, inverse = _powers()
    hashes = np.add.reduceat(_FOLDED[raw] * powers[: len(raw)], begin) * inverse[begin] + kind[begin] * _OF_KIND
    capitals = (np.add.reduceat(_UPPER[raw], begin, dtype=np.int32) > 1) & (np.add.reduceat(_LOWER[raw], begin, dtype=np.int32) == 0)
    shown = kind[begin] != _WHITE
    return begin[shown], kind[begin][shown], hashes[shown], (capitals & (kind[begin] == _WORD))[shown]


def _stream(kinds: np.ndarray, hashes: np.ndarray, capitals: np.ndarray, owner: np.ndarray, last: np.uint64 | None) -> tuple[np.ndarray, np.ndarray, np.uint64 | None]:
    """Buckets of the runs and the marks that go with them, and the text of each; ``last`` is the word before the first, and the last one comes back."""
    rows = np.zeros((len(kinds), 3), np.uint16)
    rows[:, 0], rows[:, 1] = np.where(capitals, _CAPITALS, 0), _buckets(hashes)
    words = np.flatnonzero(kinds == _WORD)
    if len(words):
        again = (hashes[words[1:]] == hashes[words[:-1]]) & (owner[words[1:]] == owner[words[:-1]])
        rows[words, 2] = np.where(np.concatenate([[last is not None and hashes[words[0]] == last], again]), _AGAIN, 0)
        last = hashes[words[-1]]
    held = rows > 0
    return rows[held], np.repeat(owner, held.sum(axis=1)), last


def _cuts(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A text in pieces of at most ``PIECE`` bytes, cut at white space, or within a word or run that is longer."""
    at = 0
    while len(raw) - at > PIECE:
        white = np.flatnonzero(_KIND[raw[at : at + PIECE]] == _WHITE)
        to = at + (int(white[-1]) + 1 if len(white) else PIECE)
        yield raw[at:to]
        at = to
    yield raw[at:]


def streams(texts: list[bytes]) -> list[np.ndarray]:
    """The buckets of each text, in order. Short texts are handled together, long ones in pieces."""
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(texts)
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (size := size + len(texts[to]) + 1) <= PIECE:
            to += 1
        if to == at:
            made, last = [], None
            for piece in _cuts(np.frombuffer(texts[at], np.uint8)):
                _, kinds, hashes, capitals = _runs(piece)
                found, _, last = _stream(kinds, hashes, capitals, np.zeros(len(kinds), np.int64), last)
                made.append(found)
            out[at] = np.concatenate(made)
            at += 1
            continue
        raw = np.frombuffer(b"\n".join(texts[at:to]) + b"\n", np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts[at : to - 1])])
        begin, kinds, hashes, capitals = _runs(raw)
        found, owner, _ = _stream(kinds, hashes, capitals, np.searchsorted(starts, begin, "right") - 1, None)
        out[at:to] = np.split(found, np.searchsorted(owner, np.arange(1, to - at)))
        at = to
    return out


def index_vectors() -> np.ndarray:
    """One row for each bucket: ``NONZERO`` places of it are 1 or -1, fewer where two fall together."""
    rng = np.random.default_rng(SEED)
    vectors = np.zeros((BUCKETS, DIM), np.int8)
    for _ in range(NONZERO):
        vectors[np.arange(BUCKETS), rng.integers(0, DIM, BUCKETS)] = rng.choice(np.array([-1, 1], np.int8), BUCKETS)
    vectors[0] = 0
    return vectors


def add_contexts(stream: np.ndarray, gap: int, vectors: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Add the contexts of a stream to the sums of its buckets; ``gap`` zeros part the texts in it, and end it."""
    for at in range(0, len(stream), TOKENS):
        begin, end = max(0, at - gap), min(len(stream), at + TOKENS + gap)
        near = np.zeros((end - begin + 2 * gap, DIM), np.int8)  # at most one from each place, so a byte holds the sum
        near[gap:-gap] = vectors[stream[begin:end]]
        context = sum((near[k : len(near) - 2 * gap + k] for k in range(2 * gap + 1) if k != gap), start=np.zeros((end - begin, DIM), np.int8))
        own, context = stream[at : at + TOKENS], context[at - begin :][:TOKENS]
        order = np.argsort(own, kind="stable")
        sorted_own = own[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_own[1:] != sorted_own[:-1]]))
        sums[sorted_own[first]] += np.add.reduceat(context[order], first, axis=0, dtype=np.int64)
        counts[sorted_own[first]] += np.diff(np.concatenate([first, [len(own)]]))


@dataclass
class Vectors:
    """Word vectors of all buckets."""

    values: np.ndarray

    @classmethod
    def of(cls, sums: np.ndarray, counts: np.ndarray) -> Vectors:
        total = max(1, counts.sum())
        contexts = sums / np.maximum(counts, 1)[:, None] - sums.sum(axis=0) / total
        contexts /= np.maximum(np.linalg.norm(contexts, axis=1, keepdims=True), 1e-9)
        contexts[counts == 0] = 0
        weight = np.sqrt(FREQUENT / (FREQUENT + counts / total))
        return cls(((contexts + OWN * index_vectors()) * weight[:, None]).astype(np.float32))

    def pooled(self, stream: np.ndarray) -> np.ndarray:
        """The features of one text: mean and deviation of its words' vectors, and its length."""
        out = np.zeros(FEATURES)
        if not len(stream):
            return out
        total, squares = np.zeros(DIM), np.zeros(DIM)
        for at in range(0, len(stream), TOKENS):
            found = self.values[stream[at : at + TOKENS]]
            total += found.sum(axis=0, dtype=np.float64)
            squares += np.einsum("ij,ij->j", found, found, dtype=np.float64)
        mean = total / len(stream)
        out[:DIM], out[DIM:-1], out[-1] = mean, np.sqrt(np.maximum(squares / len(stream) - mean * mean, 0)), np.log1p(len(stream))
        return out


def word_vectors(docs: DataFrame) -> Vectors:
    """Word vectors from the contexts of all documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = index_vectors()
        sums, counts = np.zeros((BUCKETS, DIM), np.int64), np.zeros(BUCKETS, np.int64)
        apart = np.zeros(WINDOW, np.uint16)
        for batch in slices(batches, "text", PIECE):
            stream = [x for own in streams(as_bytes(batch.column("text"))) for x in (own, apart)]
            add_contexts(np.concatenate(stream), WINDOW, vectors, sums, counts)
        counts[0] = 0
        seen = np.flatnonzero(counts)
        columns = [pa.array(seen), pa.array(counts[seen]), *(pa.array(c) for c in sums[seen].T)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n", *_SUMS])

    found = docs.select("text").mapInArrow(work, "bucket long, n long, " + ", ".join(f"{c} long" for c in _SUMS))
    table = found.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in _SUMS]).toArrow()  # a row a bucket at most
    sums, counts = np.zeros((BUCKETS, DIM), np.int64), np.zeros(BUCKETS, np.int64)
    at = table.column("bucket").to_numpy()
    counts[at] = table.column("n").to_numpy()
    for k, name in enumerate(_SUMS):
        sums[at, k] = table.column(name).to_numpy()
    return Vectors.of(sums, counts)


_SUMS = [f"s{k}" for k in range(DIM)]


@dataclass
class Network:
    """Two layers over scaled features; ``temperature`` divides what they give."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    temperature: float = 1.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Network:
        """Weights that lower the log loss: mini-batches in a fixed random order, steps scaled by running moments; small samples are gone through more often."""
        rng = np.random.default_rng(SEED)
        net = cls(x.mean(axis=0), x.std(axis=0) + 1e-6, (
            rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)))
        x = (x - net.mean) / net.scale
        weights = [w.copy() for w in net.weights]
        moments, squares, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(x)))):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                own = order[at : at + BATCH]
                step += 1
                for k, slope in enumerate(slopes(x[own], y[own], weights)):
                    moments[k] = 0.9 * moments[k] + 0.1 * slope
                    squares[k] = 0.999 * squares[k] + 0.001 * slope**2
                    weights[k] = weights[k] - RATE * (moments[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-8)
        net.weights = tuple(weights)
        return net

    def raw(self, x: np.ndarray) -> np.ndarray:
        first, bias, second, last = self.weights
        return np.tanh((x - self.mean) / self.scale @ first + bias) @ second + last[0]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of the least log loss on rows that were not fitted, by golden sections of its logarithm."""
        raw = self.raw(x)
        low, high, part = -3.0, 3.0, (5**0.5 - 1) / 2
        while high - low > 1e-4:
            a, b = high - part * (high - low), low + part * (high - low)
            if log_loss(raw / np.exp(a), y) <= log_loss(raw / np.exp(b), y):
                high = b
            else:
                low = a
        self.temperature = float(np.exp((low + high) / 2))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) / self.temperature, -500, 500)))


def log_loss(raw: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, raw) - y * raw))


def slopes(x: np.ndarray, y: np.ndarray, weights: list[np.ndarray]) -> list[np.ndarray]:
    """The gradient of the log loss with weight decay, for rows that are scaled already."""
    hidden = np.tanh(x @ weights[0] + weights[1])
    error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3][0], -500, 500))) - y) / len(y)
    back = np.outer(error, weights[2]) * (1 - hidden * hidden)
    return [x.T @ back + DECAY * weights[0], back.sum(axis=0), hidden.T @ error + DECAY * weights[2], np.array([error.sum()])]


def may_learn(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(True))


def sample(labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, quality): about ``rows`` of the labels that may be learned from, by a hash of doc_id, and no more than twice as many."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & may_learn(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    share = min(1.0, rows / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * rows)


def _pool(docs: DataFrame, vectors: Vectors, network: Network | None, columns: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, net = shared.value
        for batch in slices(batches, "text", PIECE):
            x = np.array([held.pooled(own) for own in streams(as_bytes(batch.column("text")))]).reshape(-1, FEATURES)
            values = pa.array(net.scores(x)) if net else pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], names=["doc_id", "value"])

    return docs.mapInArrow(work, columns)


def learn(docs: DataFrame, labels: DataFrame, vectors: Vectors) -> Network | float:
    """The network, or the share of label 1 where the sample does not hold both labels."""
    chosen = sample(labels)
    texts = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    one = _pool(texts, vectors, None, "doc_id long, value array<double>").groupBy("doc_id").agg(F.min("value").alias("value"))
    table = one.join(F.broadcast(chosen), "doc_id").withColumn("last", F.pmod(F.xxhash64("doc_id", F.lit("temperature")), F.lit(5)) == 0).orderBy("doc_id").toArrow()
    y = table.column("quality").to_numpy().astype(np.float64).clip(0, 1)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    x, last = np.array(table.column("value").to_pylist()), table.column("last").to_numpy(zero_copy_only=False).astype(bool)
    apart = 0 < last.sum() and len(set(y[~last].tolist())) == 2
    network = Network.fit(x[~last], y[~last]) if apart else Network.fit(x, y)
    if apart:
        network.calibrate(x[last], y[last])
    return network


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of each row of the documents."""
    session_of(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vectors = word_vectors(docs)
    network = learn(docs, labels, vectors)
    if isinstance(network, float):
        return docs.select("doc_id", F.lit(network).alias("score"))
    return _pool(docs, vectors, network, "doc_id long, value double").select("doc_id", F.col("value").alias("score"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores.select("doc_id", (~may_learn(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op13_quality": op13_quality}
ORACLES: dict[str, str] = {}
