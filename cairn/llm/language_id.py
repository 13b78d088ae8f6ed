"""Language identification of words by a linear-chain conditional random field.

Each word has affix, character n-gram and lexicon features, hashed into one
weight table; a learned matrix scores transitions between the languages of
neighbouring words. Forward-backward over the whole text gives every word's
marginals, so a word borrowed inside another language's sentence is labelled as
such. A document gets the language with the largest mean marginal, and that mean
as its score.

Training is a fit on the driver over a sample of about ``SAMPLE_ROWS`` labelled
rows a language, and ``SAMPLE_BYTES`` in all (chosen by a hash of doc_id among rows
whose crc32 is not 2 modulo 4, whole texts of at most ``SAMPLE_TEXT_BYTES``); a language of
which none is drawn gives the beginning of one text, so that every one is learned. Training
sequences splice runs of words of different languages, from which the transitions of
code-switched text are learned. The driver holds two tables of ``BUCKETS`` times the
languages in 4 bytes each, executors one: a megabyte and half of one for each language.

The filtering stage keeps a document if some language fits its words: it has letters
and the mean over its words of the largest marginal is ``MIN_CONFIDENCE`` or more.
How many languages share the document does not matter.

Defined results: ``und`` with score 0 for a null text, a text without letters or
a table without labelled rows; null languages are not learned from; repeated
rows are labelled each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, is_training_row, session_of, slices

SAMPLE_ROWS = 400
SAMPLE_TEXT_BYTES = 100_000
SAMPLE_BYTES = 64 << 20
MIN_CONFIDENCE = 0.4
BUCKETS = 1 << 17
LEXICON_LEAST = 3
SEQUENCE_WORDS, SEQUENCES, BATCH, EPOCHS, RATE, DECAY = 64, 6000, 200, 3, 0.3, 1e-5
CHUNK = 64
_SLICE = 1 << 20
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BASE, _INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letters(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _hash(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(40)


class Words:
    """Words (runs of letters, in lower case) of some texts: hashes, rows, and features of the distinct ones."""

    def __init__(self, texts: list[bytes]) -> None:
        lower = [t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
        raw = np.frombuffer(b" " + b" ".join(lower) + b"   ", np.uint8)
        inside = _IS_LETTER[raw]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        begins, ends = edges[::2], edges[1::2]
        self.raw = np.where(inside, raw, 32).astype(np.uint64)
        up, down = np.full(len(raw), _BASE, np.uint64), np.full(len(raw), _INVERSE, np.uint64)
        up[0] = down[0] = 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.raw * np.multiply.accumulate(up), dtype=np.uint64)])
        hashes = (sums[ends] - sums[begins]) * np.multiply.accumulate(down)[begins]
        self.row = np.searchsorted(np.cumsum([len(t) + 1 for t in lower]) + 1, begins, side="right")
        self.hashes, first, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        self.begins, self.ends = begins[first], ends[first]

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all features of the distinct words, one word after the other, and where each word's begin."""
        raw, b, e = self.raw, self.begins, self.ends
        n, length = len(b), e - b
        at = lambda i: raw[np.clip(i, 0, len(raw) - 1)]
        fixed = [_hash(self.hashes, 1)]
        head = tail = np.zeros(n, np.uint64)
        for k in range(3):
            head = head * np.uint64(257) + np.where(k < length, at(b + k), 0)
            tail = tail * np.uint64(257) + np.where(k < length, at(e - 1 - k), 0)
            fixed += [_hash(head, 11 + k), _hash(tail, 21 + k)]
        grams = []
        starts = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(starts, length) + np.repeat(b, length)
        two = raw[place - 1] * np.uint64(257) + raw[place]
        three = two * np.uint64(257) + raw[place + 1]
        grams = [_hash(two, 31), _hash(three, 32)]
        per = len(fixed) + 2 * length
        offset = np.cumsum(per) - per
        out = np.empty(int(per.sum()), np.int64)
        for k, f in enumerate(fixed):
            out[offset + k] = f
        inner = np.repeat(offset + len(fixed), length) + 2 * (np.arange(len(place)) - np.repeat(starts, length))
        out[inner], out[inner + 1] = grams
        return out & (BUCKETS - 1), offset


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        """Score of each language for each word, in order."""
        if not len(words.which):
            return np.zeros((0, len(self.languages)), np.float32)
        buckets, offset = words.features()
        return np.add.reduceat(self.weights[buckets], offset, axis=0)[words.which]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over sequences laid end to end.

    Sequences are cut into chunks; each chunk's product of factors is computed for all
    chunks at once, the chunks of a sequence are chained, and the messages at their
    borders are then carried inside. The result is that of one pass over each sequence.
    """
    n, k = scores.shape
    if not n:
        return np.zeros((0, k), np.float32)
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    sizes = sizes[sizes > 0]
    per = -(-sizes // CHUNK)
    first = np.cumsum(per) - per
    ordinal = np.arange(int(per.sum())) - np.repeat(first, per)
    begin = np.repeat(np.cumsum(sizes) - sizes, per) + ordinal * CHUNK
    length = np.minimum(CHUNK, np.repeat(np.cumsum(sizes), per) - begin)
    place = np.minimum(begin[:, None] + np.arange(CHUNK), n - 1)
    real = np.arange(CHUNK) < length[:, None]
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-20)
    local = local[place]
    chunks, opening = len(begin), ordinal == 0

    product = np.broadcast_to(np.eye(k, dtype=np.float32), (chunks, k, k)).copy()
    for t in range(CHUNK):
        moved = product if t == 0 and opening.all() else product @ step
        if t == 0:
            moved = np.where(opening[:, None, None], product, moved)
        moved = moved * local[:, t, None, :]
        moved /= moved.max(axis=(1, 2), keepdims=True)
        product = np.where(real[:, t, None, None], moved, product)

    before, after = np.full((chunks, k), 1 / k, np.float32), np.full((chunks, k), 1 / k, np.float32)
    for j in range(1, int(per.max())):
        at = first[per > j] + j
        before[at] = _scaled(np.einsum("ck,ckl->cl", before[at - 1], product[at - 1]))
    for j in range(int(per.max()) - 1, 0, -1):
        at = first[per > j] + j
        after[at - 1] = _scaled(np.einsum("ckl,cl->ck", product[at], after[at]))

    forward = np.empty((CHUNK, chunks, k), np.float32)
    state = before
    for t in range(CHUNK):
        moved = state @ step if t else np.where(opening[:, None], state, state @ step)
        moved = _scaled(moved * local[:, t])
        forward[t] = state = np.where(real[:, t, None], moved, state)
    out, state = np.empty((n, k), np.float32), after
    for t in range(CHUNK - 1, -1, -1):
        on = real[:, t]
        out[place[on, t]] = _scaled(forward[t][on] * state[on])
        moved = _scaled((local[:, t] * state) @ step.T)
        state = np.where(on[:, None], moved, state)
    return out


def _spliced(languages: np.ndarray, row: np.ndarray, label: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Word places and labels of training sequences: runs of words of random languages."""
    size = np.bincount(row, minlength=len(label))
    start = np.cumsum(size) - size
    rows_of = [np.flatnonzero((label == c) & (size > 0)) for c in range(len(languages))]
    usable = [c for c, r in enumerate(rows_of) if len(r)]
    words, labels = np.zeros((SEQUENCES, SEQUENCE_WORDS), np.int64), np.zeros((SEQUENCES, SEQUENCE_WORDS), np.int64)
    for s in range(SEQUENCES):
        at = 0
        while at < SEQUENCE_WORDS:
            c = usable[rng.integers(len(usable))]
            r = rows_of[c][rng.integers(len(rows_of[c]))]
            run = min(int(rng.geometric(1 / 24)), SEQUENCE_WORDS - at, int(size[r]))
            begin = start[r] + rng.integers(size[r] - run + 1)
            words[s, at : at + run], labels[s, at : at + run] = np.arange(begin, begin + run), c
            at += run
    return words, labels


def fit(texts: list[bytes], languages: list[str]) -> Model:
    """Fit by AdaGrad on the log-likelihood of spliced sequences."""
    names = sorted(set(languages))
    k = len(names)
    words = Words(texts)
    if not len(words.which) or k == 0:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0), np.float32))
    rng = np.random.default_rng(4)
    label = np.array([names.index(x) for x in languages])
    place, gold = _spliced(np.array(names), words.row, label, rng)
    buckets, offset = words.features()
    counts = np.diff(np.append(offset, len(buckets)))
    rare = np.bincount(words.which, minlength=len(offset)) < LEXICON_LEAST
    buckets[offset[rare]] = BUCKETS  # a word outside the lexicon has no weight of its own
    weights, seen = np.zeros((BUCKETS + 1, k), np.float32), np.full((BUCKETS + 1, k), 1e-2, np.float32)
    move, move_seen = np.zeros((k, k), np.float32), np.full((k, k), 1.0, np.float32)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(SEQUENCES), SEQUENCES // BATCH):
            which = words.which[place[batch]]
            distinct, inverse = np.unique(which, return_inverse=True)
            n = counts[distinct]
            begins = np.cumsum(n) - n
            flat = buckets[np.arange(int(n.sum())) - np.repeat(begins, n) + np.repeat(offset[distinct], n)]
            scores = np.add.reduceat(weights[flat], begins, axis=0)[inverse.reshape(which.shape)]
            grad, pairs = _gradient(scores, gold[batch], move)
            by_word = np.zeros((len(distinct), k), np.float32)
            np.add.at(by_word, inverse.ravel(), grad.reshape(-1, k))
            total = np.zeros_like(weights)
            np.add.at(total, flat, np.repeat(by_word, n, axis=0))
            total = total / len(batch) - DECAY * weights
            total[BUCKETS] = 0
            seen += total * total
            weights += RATE * total / np.sqrt(seen)
            pairs = pairs / len(batch) - 1e-3 * move
            move_seen += pairs * pairs
            move += RATE * pairs / np.sqrt(move_seen)
    return Model(names, weights[:BUCKETS].copy(), move)


def _gradient(scores: np.ndarray, gold: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood by the scores and, summed, by the transitions."""
    b, t, k = scores.shape
    step = np.exp(move - move.max())
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    forward, backward = np.empty_like(local), np.full_like(local, 1 / k)
    forward[:, 0] = _scaled(local[:, 0])
    for i in range(1, t):
        forward[:, i] = _scaled((forward[:, i - 1] @ step) * local[:, i])
    pairs = np.zeros((k, k), np.float32)
    for i in range(t - 1, 0, -1):
        onward = local[:, i] * backward[:, i]
        joint = forward[:, i - 1, :, None] * step * onward[:, None, :]
        pairs -= (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        backward[:, i - 1] = _scaled(onward @ step.T)
    np.add.at(pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    grad = -_scaled(forward * backward)
    np.put_along_axis(grad, gold[:, :, None], np.take_along_axis(grad, gold[:, :, None], 2) + 1, 2)
    return grad, pairs


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on the sample of labelled rows that the module's text describes."""
    spark = session_of(docs)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & is_training_row(F.col("doc_id"))).select("doc_id", "lang", "text")
    short = F.octet_length("text") <= SAMPLE_TEXT_BYTES
    counts = known.groupBy("lang").agg(F.count_if(short).alias("n"), F.sum(F.when(short, F.octet_length("text"))).alias("size")).orderBy("lang").collect()  # a row a language
    if not counts:
        return fit([], [])
    most = sample_bytes / len(counts)
    shares = [(r["lang"], min(1.0, sample_rows / max(1, r["n"]), most / max(1, r["size"] or 0))) for r in counts]
    share = spark.createDataFrame(shares, "lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    rows = known.where(short).join(F.broadcast(share), "lang").where(draw).select("doc_id", "lang", "text").limit(2 * sample_rows * len(counts)).collect()
    drawn = {r["lang"] for r in rows}
    if undrawn := [(r["lang"],) for r in counts if r["lang"] not in drawn]:
        # of each of these the text that a hash puts first, from its beginning
        others = known.join(F.broadcast(spark.createDataFrame(undrawn, "lang string")), "lang").withColumn("at", F.xxhash64("doc_id", "text"))
        first = others.groupBy("lang").agg(F.min("at").alias("at"))
        rows += others.join(F.broadcast(first), ["lang", "at"]).dropDuplicates(["lang"]).select("doc_id", "lang", F.substring("text", 1, int(min(SAMPLE_TEXT_BYTES, most))).alias("text")).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    return fit([r["text"].encode() for r in rows], [r["lang"] for r in rows])


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Groups of (row, bytes) of bounded size; long texts are cut between words."""
    held, size = [], 0
    for r, text in enumerate(texts):
        low = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()
        at = 0
        while at < len(low):
            end = min(len(low), at + _SLICE)
            while end < len(low) and _IS_LETTER[low[end]]:
                end += 1
            held.append((r, low[at:end]))
            size += end - at
            at = end
            if size >= _SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def label_texts(model: Model, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score (the language's mean marginal) and confidence (the mean of each word's largest marginal) of each text."""
    languages, score, confidence = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    emissions, rows = [], []
    for group in _pieces(texts) if model.languages else ():
        words = Words([p for _, p in group])
        emissions.append(model.emissions(words))
        rows.append(np.array([r for r, _ in group], np.int64)[words.row])
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    if not len(row):
        return languages, score, confidence
    size = np.bincount(row, minlength=len(texts))
    found = marginals(np.concatenate(emissions), size, model.transitions)
    some = np.flatnonzero(size)
    begins = (np.cumsum(size) - size)[some]
    mean = np.add.reduceat(found, begins, axis=0, dtype=np.float64) / size[some, None]
    sure = np.add.reduceat(found.max(axis=1), begins, dtype=np.float64) / size[some]
    for r, p, c in zip(some.tolist(), mean, sure.tolist(), strict=True):
        if has_letters(texts[r]):
            best = int(p.argmax())
            languages[r], score[r], confidence[r] = model.languages[best], min(1.0, float(p[best])), min(1.0, c)
    return languages, score, confidence


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, lang_pred and score of each row."""
    spark = session_of(docs)
    shared = spark.sparkContext.broadcast(model or learn(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            languages, score, _ = label_texts(shared.value, as_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None = None, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The documents that some language fits, at ``min_confidence`` or more, with all their columns; no shuffle."""
    spark = session_of(docs)
    shared = spark.sparkContext.broadcast(model or learn(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            languages, _, confidence = label_texts(shared.value, as_bytes(batch.column("text")))
            yield batch.filter(pa.array([x != "und" and c >= min_confidence for x, c in zip(languages, confidence, strict=True)], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs).select("doc_id", (~is_training_row(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_language_id": op4_language_id}
ORACLES: dict[str, str] = {}
