"""Secret scans in DataFrame expressions only.

Spans of a pattern are found natively: a text is split by the pattern and all
its matches are extracted; the lengths of pieces and matches, in code points,
add up to the offsets. Beside three fixed patterns, candidate strings are judged
by Shannon entropy in a sliding window: the characters of a candidate are folded
once, and each step adjusts the count of the character that enters and of the
one that leaves, and with them the window's sum of c*log2(c). The highest
window of a candidate is held against the threshold of its character class; the
allow list suppresses words, plain numbers, UUIDs and the like.

Defined results: a null text counts as empty and has no spans; repeated rows are
scanned each; spans of different kinds may overlap; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8
#: Entropy method: candidates, window, and bits a character by class of the whole candidate, tried in this order.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+$", 3.0),
    ("alphanumeric", r"^[A-Za-z0-9]+$", 3.6),
    ("base64", r"^[A-Za-z0-9+/_-]+$", 3.8),
)
ALLOWED = (
    r"^[^0-9]*$",  # words, however long
    r"^[0-9_-]+$",  # plain numbers and dates
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"EXAMPLE",
    r"^[A-Za-z]+[0-9]{1,4}$",  # a word with a number
    r"^[a-z0-9]+([/_-][a-z0-9]{1,12})+$",  # paths and slugs
)
KINDS = ("assign", "access", "hex", "entropy")
_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
_FIRST, _SLOTS = 43, 80  # '+' to 'z'


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, pattern: str, kind: int, good: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the leftmost, non-overlapping matches of a pattern that ``good`` accepts."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(held: Column, pair: Column) -> Column:
        begin = held["at"] + F.char_length(pair["piece"])
        end = begin + F.char_length(pair["match"])
        span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        kept = F.concat(held["spans"], span)
        if good:
            kept = F.when(good(pair["match"]), kept).otherwise(held["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    return F.when(text.rlike(pattern), F.aggregate(pairs, start, step, lambda held: held["spans"])).otherwise(F.array().cast(_SPAN))


def window_entropy(token: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits a character, of any window of a string of ``CANDIDATE`` characters."""
    weight = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))
    slot = lambda i: F.ascii(F.substr(token, i, F.lit(1))) - F.lit(_FIRST)

    def moved(held: Column, at: Column, by: int) -> Column:
        count = F.element_at(held["counts"], at + 1)
        counts = F.transform(held["counts"], lambda c, k: F.when(k == at, c + by).otherwise(c))
        return F.struct(counts.alias("counts"), (held["sum"] - weight(count) + weight(count + by)).alias("sum"), held["best"].alias("best"))

    def step(held: Column, i: Column) -> Column:
        left = F.when(i > window, moved(held, slot(i - window), -1)).otherwise(held)
        both = _let(left, lambda h: moved(h, slot(i), 1))
        size = F.least(i, F.lit(window))
        bits = lambda h: F.log2(size) - h["sum"] / size
        whole = (i >= window) | (i == F.char_length(token))
        return _let(both, lambda h: F.struct(h["counts"].alias("counts"), h["sum"].alias("sum"), F.when(whole, F.greatest(h["best"], bits(h))).otherwise(h["best"]).alias("best")))

    start = F.struct(F.array_repeat(F.lit(0), _SLOTS).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.char_length(token)), start, step, lambda held: held["best"])


def _is_random(token: Column, allowed: tuple[str, ...]) -> Column:
    enough = F.lit(None).cast("double")
    for _, pattern, bits in reversed(CLASSES):
        enough = F.when(token.rlike(pattern), F.lit(bits)).otherwise(enough)
    known = F.lit(False)
    for pattern in allowed:
        known = known | token.rlike(pattern)
    return F.when(known, F.lit(False)).otherwise(F.coalesce(window_entropy(token) >= enough, F.lit(False)))


def scan_secrets(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id and spans: array of (start, kind, end), by start and then kind, offsets in code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    value = lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST
    found = docs.select(
        "doc_id", _spans(text, ASSIGN, 0, value).alias("assign"), _spans(text, ACCESS, 1).alias("access"),
        _spans(text, HEX, 2).alias("hex"), _spans(text, CANDIDATE, 3, lambda m: _is_random(m, allowed)).alias("entropy"))
    return found.select("doc_id", F.array_sort(F.concat("assign", "access", "hex", "entropy")).alias("spans"))


def _shown(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_shown(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"))


QUERIES = {"op6_secrets": op6_secrets}
ORACLES: dict[str, str] = {}
