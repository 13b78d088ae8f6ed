"""Toxicity scores by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of an insult lexicon (as written, and behind
obfuscation), insults close to the second person, capitals, punctuation, and
rates of obfuscated and stretched words. The lexicon is a short fixed list and
words learned by the lower bound of their log-odds; a listed
word that the labels speak against is left out. Trees and calibration are fitted by Spark.

Learning uses only labelled rows whose crc32 of doc_id is not 2 modulo 4, split
by a hash of doc_id into three parts: one for the lexicon (a sample of about
``LEXICON_ROWS`` rows of texts of at most ``LEXICON_TEXT_BYTES``; its words are
counted by Spark, and all that pass the bound on their log-odds are learned), one for
the trees and one for the calibration (both about ``FIT_ROWS`` rows of features).
What reaches the driver is the learned words alone. A score is the calibrated value
of the isotonic step function, no more.

Defined results: a null text counts as empty and is scored like any other; rows
labelled twice count with the higher label, null labels not at all; without rows
of both labels every score is the share of toxic ones (0 if there are none);
repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, cut, is_training_row, session_of, slices

LEXICON_ROWS, LEXICON_TEXT_BYTES, FIT_ROWS = 6000, 100_000, 20_000
#: Distinct words of a text that the lexicon counts are ASCII or other letters, of bounded length.
WORD_CHARS = 40
TREES, DEPTH, RATE = 20, 4, 0.2
THRESHOLD = 0.3
LEARNED_LEAST, LEARNED_ODDS = 8, 0.5
NEAR_WORDS = 4
#: Common insults and second-person words.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers pathetic scum trash garbage worthless clown disgusting "
    "fool fools jerk creep liar imbecile coward filth vermin degenerate"
).split()
SECOND_PERSON = "you your yours yourself youre u ur du dich dir dein deine euch ihr tu te toi ton vous votre usted ustedes tus ti".split()
_LEET = str.maketrans("01345@$!7", "oieasasit")
_STRETCHED = re.compile(r"(.)\1{2,}")
_INNER = re.compile(r"\w[^\w\s'’-]+\w|[A-Za-z]\d+[A-Za-z]|[A-Za-z][*_.-][A-Za-z][*_.-]")
_EDGE = re.compile(r"^\W+|\W+$")
_PLAIN = re.compile(r"[^\w]|_")
_LEX, _HIDDEN, _YOU, _CAPS, _OBFUSCATED, _STRETCH, _TITLE = (1 << k for k in range(7))
FEATURES = (
    "lexicon", "lexicon_count", "lexicon_weight", "lexicon_distinct", "hidden", "hidden_count", "near_you", "near_you_count", "you",
    "caps_words", "capitals", "exclamation", "question", "punctuation", "obfuscated", "stretched", "digits", "words",
)
#: Words whose marks a worker remembers, and their longest; a bound on memory that results do not depend on.
_REMEMBERED, _REMEMBERED_CHARS = 200_000, 40


class Marks(dict):
    """Word as written to its marks: flags, and the lexicon weight (hundredths) above them; computed when first met."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> int:
        core = _EDGE.sub("", word)
        low = core.lower()
        mark, weight = 0, self.weights.get(low)
        if weight is not None:
            mark |= _LEX
        else:
            bare = _PLAIN.sub("", word.lower().translate(_LEET))
            for form in (bare, _STRETCHED.sub(r"\1", bare), _STRETCHED.sub(r"\1\1", bare)):
                if form != low and (weight := self.weights.get(form)) is not None:
                    mark |= _HIDDEN
                    break
        if low in _SECOND:
            mark |= _YOU
        if len(core) > 1 and core.isupper():
            mark |= _CAPS
        if _INNER.search(core):
            mark |= _OBFUSCATED
        if _STRETCHED.search(core):
            mark |= _STRETCH
        if weight is not None:
            mark |= int(min(99, max(0, weight)) * 100) << 8
        if len(word) <= _REMEMBERED_CHARS:
            if len(self) > _REMEMBERED:
                self.clear()
            self[word] = mark
        return mark


_SECOND = frozenset(SECOND_PERSON)


def text_features(text: str, marks: Marks) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    words = text.split()
    n = len(words)
    found = np.fromiter(map(marks.__getitem__, words), np.int64, n)
    lexicon, hidden, you = (found & _LEX) > 0, (found & _HIDDEN) > 0, (found & _YOU) > 0
    hit = lexicon | hidden
    places = np.flatnonzero(hit)
    near = 0
    if len(places) and you.any():
        sums = np.concatenate([[0], np.cumsum(you)])
        near = int((sums[np.minimum(n, places + NEAR_WORDS + 1)] > sums[np.maximum(0, places - NEAR_WORDS)]).sum())
    weights = (found[places] >> 8) / 100
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    size, per = max(1, len(raw)), max(1, n)
    share = lambda flag: float(((found & flag) > 0).sum()) / per
    punctuation = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    return [
        lexicon.sum() / per, math.log1p(lexicon.sum()), float(weights.sum()) / per, math.log1p(len({words[p].lower() for p in places.tolist()})),
        hidden.sum() / per, math.log1p(hidden.sum()), near / per, math.log1p(near), you.sum() / per,
        share(_CAPS), counts[65:91].sum() / letters, counts[33] / size, counts[63] / size, float(punctuation) / size,
        share(_OBFUSCATED), share(_STRETCH), counts[48:58].sum() / size, math.log1p(n),
    ]


def words_of(text: str) -> set[str]:
    """The distinct words of a text that can be learned: letters only, in lower case."""
    return {low for w in text.split() if (low := _EDGE.sub("", w).lower()).isalpha() and len(low) <= WORD_CHARS}


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of insults from (text, toxic) rows: the fixed list, and words far more frequent in toxic texts.

    A word counts by the lower bound (95 %) of its log-odds between toxic and other
    texts; a listed word that the labels speak against is left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for raw, toxic in zip(as_bytes(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                found = sorted(words_of(raw.decode("utf-8", "replace")))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], names=["word", "toxic"])

    n = rows.agg(F.count_if(F.col("toxic") > 0).alias("yes"), F.count_if(F.col("toxic") <= 0).alias("no")).first()
    counts = rows.select("text", "toxic").mapInArrow(work, "word string, toxic int").groupBy("word").agg(
        F.count_if(F.col("toxic") > 0).alias("yes"), F.count_if(F.col("toxic") <= 0).alias("no")).where(F.col("yes") + F.col("no") >= LEARNED_LEAST)
    k, m = F.col("yes") + 0.5, F.col("no") + 0.5
    odds = F.log(k / (n["yes"] + 1)) - F.log(m / (n["no"] + 1)) - 1.96 * F.sqrt(1 / k + 1 / m)
    judged = counts.withColumn("odds", odds).where((F.col("odds") >= LEARNED_ODDS) | F.col("word").isin(list(INSULTS))).select("word", "odds").collect()
    found = {r["word"]: r["odds"] for r in judged}
    return {w: 1.0 for w in INSULTS if found.get(w, LEARNED_ODDS) >= LEARNED_ODDS} | {w: o for w, o in sorted(found.items()) if o >= LEARNED_ODDS}


def features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """doc_id and one double for each of ``FEATURES``."""
    spark = session_of(docs)
    shared = spark.sparkContext.broadcast(lexicon)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(shared.value)
        for batch in slices(batches, "text"):
            rows = np.array([text_features(raw.decode("utf-8", "replace"), marks) for raw in as_bytes(batch.column("text"))], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, rows.T)], names=["doc_id", *FEATURES])

    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)


def _part(first: int, last: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(10)).between(first, last)


def _bounded(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of ``n`` rows, chosen by a hash of doc_id, and no more than twice as many."""
    share = min(1.0, most / max(1, n))
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * most)


def calibration(rows: DataFrame) -> IsotonicRegressionModel:
    """The isotonic function from ``raw`` to the share of toxic rows."""
    return IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated").fit(rows.select("raw", F.col("toxic").cast("double").alias("toxic")))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of each row of the documents."""
    spark = session_of(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & is_training_row(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["p"]: r["n"] for r in known.groupBy(F.when(_part(0, 4), "lexicon").when(_part(5, 7), "trees").otherwise("calibration").alias("p")).agg(F.count("*").alias("n")).collect()}
    sample = _bounded(known.where(_part(0, 4)), n.get("lexicon", 0), LEXICON_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= LEXICON_TEXT_BYTES)
    lexicon = learn_lexicon(cut(texts.join(F.broadcast(sample), "doc_id")))

    own = cut(features(docs, lexicon))
    learning = {
        p: cut(own.join(F.broadcast(_bounded(known.where(_part(*between)), n.get(p, 0), FIT_ROWS)), "doc_id").coalesce(2))
        for p, between in (("trees", (5, 7)), ("calibration", (8, 9)))
    }
    shares = {p: d.agg(F.avg("toxic").alias("m")).first()["m"] or 0.0 for p, d in learning.items()}
    if not 0 < shares["trees"] < 1:
        return own.select("doc_id", F.lit(float(shares["trees"])).alias("score"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=5, cacheNodeIds=False).fit(assembler.transform(learning["trees"]))

    def raw(d: DataFrame) -> DataFrame:
        return trees.transform(assembler.transform(d)).withColumn("raw", vector_to_array("probability")[1])

    if not 0 < shares["calibration"] < 1:
        return raw(own).select("doc_id", F.col("raw").alias("score"))
    isotonic = calibration(raw(learning["calibration"]).select("raw", "toxic"))
    calibrated = isotonic.transform(raw(own).select("doc_id", "raw"))
    return calibrated.select("doc_id", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)).alias("score"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores.select("doc_id", (~is_training_row(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}
