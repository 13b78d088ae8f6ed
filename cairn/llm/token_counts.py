"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton gives, at each position of a word, every vocabulary
piece that ends there, the longest first; dynamic programming carries the best
score and the number of pieces of that best path, and no path is stored. Ties
follow the Unigram model of the tokenizers library: an earlier start wins unless
a later one is strictly better, sums run from the left in double precision, a
character without a piece of its own costs the lowest score less 10, and with
byte fallback counts one piece for each of its UTF-8 bytes.

White space is handled as by that library's Metaspace pre-tokenizer: a text is
cut before each space, which is written as a visible mark, and gets one in front
if it has none. So words are independent, and a worker remembers their counts.

Pieces and scores are read from a public SentencePiece file, whose path is a
parameter; nothing is trained.

Defined results: a null or empty text has no tokens and score 0; repeated rows are
counted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, session_of, slices

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNKNOWN_PENALTY = 10.0
_NEVER = float("-inf")
#: Words whose counts a worker remembers, and their longest; a bound on memory that results do not depend on.
REMEMBERED, REMEMBERED_CHARS = 300_000, 40


def read_pieces(path: str) -> list[tuple[str, float]]:
    """All pieces of a SentencePiece file with their scores, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Word (with its mark) to (pieces, score); computed when first met."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True, remembered: int = REMEMBERED) -> None:
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {p for p, _ in pieces}
        self.single = frozenset(p for p in names if len(p) == 1)
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        self.remembered = remembered

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.viterbi(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) > self.remembered:
                self.clear()
            self[word] = found
        return found

    def viterbi(self, word: str) -> tuple[int, float]:
        if not self.single.issuperset(word):
            return self._viterbi_unknown(word)
        best, count = [0.0] + [_NEVER] * len(word), [0] * (len(word) + 1)
        for last, (length, score) in self.automaton.iter(word):
            last += 1
            begin = last - length
            score += best[begin]
            if score > best[last]:
                best[last], count[last] = score, count[begin] + 1
        return count[-1], best[-1]

    def _viterbi_unknown(self, word: str) -> tuple[int, float]:
        """The same where some characters have no piece of their own."""
        n, single, unknown = len(word), self.single, self.unknown
        best, count, open_ = [0.0] + [_NEVER] * n, [0] * (n + 1), [False] * (n + 1)
        settled = 0

        def settle(upto: int) -> None:
            """Positions up to here have all their pieces; add unknown characters."""
            nonlocal settled
            for e in range(settled + 1, upto + 1):
                if word[e - 1] not in single and best[e - 1] + unknown > best[e]:
                    best[e] = best[e - 1] + unknown
                    if self.bytes:
                        count[e] = count[e - 1] + len(word[e - 1].encode("utf-8", "replace"))
                    else:
                        count[e], open_[e] = count[e - 1] + (not open_[e - 1]), True
            settled = upto

        for last, (length, score) in self.automaton.iter(word):
            if last > settled:
                settle(last)
            begin = last + 1 - length
            score += best[begin]
            if score > best[last + 1]:
                best[last + 1], count[last + 1], open_[last + 1] = score, count[begin] + 1, False
        settle(n)
        return count[n], best[n]

    def of_text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = text.replace(" ", MARK)
        _, *rest = marked.split(MARK) if marked[0] == MARK else ("", *marked.split(MARK))
        found = [self[MARK + w] for w in rest]
        return sum(c for c, _ in found), sum(s for _, s in found)


@lru_cache(maxsize=2)
def counter(path: str, byte_fallback: bool = True) -> Counter:
    return Counter(read_pieces(path), byte_fallback)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, byte_fallback: bool = True) -> DataFrame:
    """doc_id, n_tokens and score (of the best segmentation) of each row."""
    session_of(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(vocabulary, byte_fallback)
        for batch in slices(batches, "text"):
            found = [tool.of_text(raw.decode("utf-8", "replace")) for raw in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([c for c, _ in found], pa.int64()), pa.array([float(s) for _, s in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, n_tokens long, score double")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLES: dict[str, str] = {}
