"""Chunks and sentences of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunks(docs: DataFrame, id_: str, text: str, size: int = 1000, overlap: int = 100) -> DataFrame:
    """Pieces of ``size`` characters that overlap by ``overlap``: (id, chunk_no, begin, chunk)."""
    if not 0 <= overlap < size:
        raise ValueError("0 <= overlap < size")
    n, step = F.char_length(text), size - overlap
    last = F.greatest(F.ceil((n - overlap) / step), F.lit(1)) - 1
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("long"), last.cast("long")))
    return docs.select(id_, F.col(text).alias("_t"), F.explode(starts).alias("chunk_no")).select(
        id_, "chunk_no", (F.col("chunk_no") * step).alias("begin"), F.substr(F.col("_t"), (F.col("chunk_no") * step + 1).cast("int"), F.lit(size)).alias("chunk"))


#: Marks that may follow a sentence's end.
_CLOSERS = "\"'’”」』"


def sentences(text: Column, drop_spaces: bool = False) -> Column:
    """Array of the sentences of a text.

    A sentence ends after a terminator or an ellipsis, with the quotes that close it,
    or at a line's end; a full stop inside a word or number does not end one.
    """
    marked = F.regexp_replace(text, rf"((?:\.{{3,}}|…+|[。！？!?;；]+|\.(?=\s|$|[{_CLOSERS}]))[{_CLOSERS}]*)\s*", "$1\n")
    parts = F.transform(F.split(marked, r"\n+"), lambda s: F.regexp_replace(s, r"\s+", "") if drop_spaces else F.trim(s))
    return F.filter(parts, lambda s: s != "")


def sized_sentences(text: Column, size: int) -> Column:
    """Sentences; one longer than ``size`` is cut at commas, then at spaces, then by length."""
    cut = lambda parts, pattern: F.flatten(F.transform(parts, lambda s: F.when(F.char_length(s) > size, F.filter(F.split(F.regexp_replace(s, pattern, "$1\n"), "\n"), lambda p: p != "")).otherwise(F.array(s))))
    by_length = lambda s: F.transform(F.sequence(F.lit(0), F.ceil(F.char_length(s) / size).cast("int") - 1), lambda i: F.substr(s, i * size + 1, F.lit(size)))
    parts = cut(cut(sentences(text), "([,，、:：])"), r"(\s)")
    return F.flatten(F.transform(parts, lambda s: F.when(F.char_length(s) > size, by_length(s)).otherwise(F.array(s))))


def options(text: Column) -> Column:
    """Map of the ``'key' = 'value'`` pairs of WITH (...) or OPTIONS (...) clauses; the last value of a key holds."""
    body = F.array_join(F.regexp_extract_all(text, F.lit(r"(?is)\b(?:WITH|OPTIONS)\s*\(((?:[^()']|'(?:[^']|'')*')*)\)"), F.lit(1)), ",")
    pair = r"'((?:[^']|'')*)'\s*=\s*'((?:[^']|'')*)'"
    keys, values = F.regexp_extract_all(body, F.lit(pair), F.lit(1)), F.regexp_extract_all(body, F.lit(pair), F.lit(2))
    plain = lambda a: F.transform(a, lambda v: F.replace(v, F.lit("''"), F.lit("'")))
    pairs = F.zip_with(plain(keys), plain(values), lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)
