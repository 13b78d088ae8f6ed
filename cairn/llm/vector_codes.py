"""Vector code compression: integer codebooks for equal parts of a vector, searched by vantage-point trees.

Every component becomes the integer floor(256 x); a vector is cut into 16 equal parts,
each with a codebook of its own. A part's nearest entry is found in a vantage-point tree
over the codebook by branch and bound: distances from a vantage entry and the radii of
the two halves are square roots rounded outwards, a half is visited unless it is
certainly farther (so at an equal bound too), and what decides is the exact squared
distance in integers, at ties the lower index. A batch goes down the tree together, the
rows nearer to a half first.

Each round is one pass over the vectors: a task adds its parts up by entry, Spark adds
the sums of the tasks. What reaches the driver is the codebooks, 64 vectors in all.

Defined results: rows whose vector is null, empty, of another length than most (ties:
the longer) or holds null or non-finite components are dropped; a length that 16 does not
divide is filled up with zeros; null ids come last among the first 64, equal ids in the
order of their components; fewer than 64 vectors make smaller codebooks; repeated rows
count each; integers beyond 2 ** 62 count as 2 ** 62, and errors beyond a long as the
largest long; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import session_of, shared_dir, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Entries of a part of the tree that are looked at together.
LEAF = 8
#: Rows of label sums that may be broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 100_000
LARGEST, LONG = 1 << 62, (1 << 63) - 1
_OUTWARDS = 2.0**-50


def _below(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(squares, np.float64)) * (1 - _OUTWARDS)


def _above(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(squares, np.float64)) * (1 + _OUTWARDS)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``a`` to each of ``b``."""
    gap = a[:, None, :] - b[None]
    return (gap * gap).sum(2)


def exact_type(largest: int, length: int) -> type:
    """int64 where no squared distance of vectors of this length can leave it, else Python's integers."""
    return np.int64 if 4 * largest * largest * max(1, length) < 1 << 62 else object


class VantageTree:
    """The entries of one codebook, for exact nearest-entry search of many rows at once."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.root = self._grow(np.arange(len(entries)))

    def _grow(self, own: np.ndarray) -> tuple:
        """(entries, None, None) or (entries looked at here, inner, outer), a half being (least radius, greatest radius, node)."""
        if len(own) <= LEAF:
            return own, None, None
        among = _squares(self.entries[own], self.entries[own])
        vantage = int(np.argmax(np.sqrt(among.astype(np.float64)).std(axis=1)))
        rest = np.flatnonzero(np.arange(len(own)) != vantage)
        rest = rest[np.argsort(among[vantage][rest], kind="stable")]
        halves = []
        for half in (rest[: len(rest) // 2], rest[len(rest) // 2 :]):
            reach = among[vantage][half]
            halves.append((float(_below(reach.min())), float(_above(reach.max())), self._grow(np.sort(own[half]))))
        return own[[vantage]], *halves

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, the lower of equally near ones, and its squared distance."""
        found = np.full(len(rows), len(self.entries), np.int64)
        least = np.zeros(len(rows), rows.dtype)
        self._visit(self.root, np.arange(len(rows)), rows, found, least)
        return found, least

    def _visit(self, node: tuple, at: np.ndarray, rows: np.ndarray, found: np.ndarray, least: np.ndarray) -> None:
        if not len(at):
            return
        own, inner, outer = node
        squares = _squares(rows[at], self.entries[own])
        first = squares.argmin(axis=1)
        near, entry = squares[np.arange(len(at)), first], own[first]
        better = (found[at] == len(self.entries)) | (near < least[at]) | ((near == least[at]) & (entry < found[at]))
        found[at[better]], least[at[better]] = entry[better], near[better]
        if inner is None:
            return
        low, high = _below(near), _above(near)
        into = high <= (inner[1] + outer[0]) / 2
        for ours, first_half, second_half in ((into, inner, outer), (~into, outer, inner)):
            self._visit(first_half[2], at[ours], rows, found, least)
            gap = np.maximum(low[ours] - second_half[1], second_half[0] - high[ours])
            self._visit(second_half[2], at[ours][gap <= _above(least[at[ours]])], rows, found, least)


def trees_of(books: list[np.ndarray], kind: type) -> list[VantageTree]:
    return [VantageTree(b.astype(kind)) for b in books]


def integers(column: pa.Array, length: int) -> np.ndarray:
    """The rows of a column of vectors as integers, filled up with zeros to a multiple of the parts."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), length)
    whole = np.clip(np.floor(values * SCALE), -float(LARGEST), float(LARGEST))
    largest = int(np.abs(whole).max()) if whole.size else 0
    out = whole.astype(np.int64).astype(exact_type(largest, length))
    return np.pad(out, ((0, 0), (0, -length % PARTS)))


def _largest(*arrays: np.ndarray) -> int:
    return max((int(np.abs(a).max()) for a in arrays if a.size), default=0)


def nearest_entries(rows: np.ndarray, books: list[np.ndarray], trees: dict[type, list[VantageTree]]) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part of every row; ``trees`` keeps those made before."""
    kind = exact_type(_largest(rows, *books), rows.shape[1])
    if kind not in trees:
        trees[kind] = trees_of(books, kind)
    cut = np.split(rows.astype(kind), PARTS, axis=1)
    each = [tree.nearest(np.ascontiguousarray(part)) for tree, part in zip(trees[kind], cut, strict=True)]
    return np.stack([e for e, _ in each], axis=1), np.stack([d for _, d in each], axis=1)


def usable(vectors: DataFrame, id_: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """(id, vector, label) of the rows that are kept, and the length of their vectors (0: there are none)."""
    inf = F.lit(float("inf"))
    rows = vectors.select(F.col(id_).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < inf)))
    most = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    length = most["length"] if most else 0
    return rows.where(F.size("vector") == length), length


def first_entries(rows: DataFrame, length: int) -> list[np.ndarray]:
    """The codebooks to start from: the parts of the vectors with the smallest ids."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").toArrow().combine_chunks()
    return np.split(integers(first.column("vector").combine_chunks(), length), PARTS, axis=1)


def next_entries(rows: DataFrame, books: list[np.ndarray], length: int) -> list[np.ndarray]:
    """The codebooks after one round: each entry the floored mean of its parts; entries without a part stay."""
    width = books[0].shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, trees = shared.value, {}
        totals, counts = np.zeros((PARTS, len(held[0]), width), object), np.zeros((PARTS, len(held[0])), np.int64)
        for batch in batches:
            vectors = integers(batch.column("vector"), length)
            entries, _ = nearest_entries(vectors, held, trees)
            own = np.zeros(totals.shape, vectors.dtype)
            part = np.broadcast_to(np.arange(PARTS), entries.shape)
            np.add.at(own, (part, entries), vectors.reshape(len(vectors), PARTS, width))
            np.add.at(counts, (part, entries), 1)
            totals += own.astype(object)
        part, entry = np.nonzero(counts)
        if len(part):
            columns = [np.repeat(part, width), np.repeat(entry, width), np.tile(np.arange(width), len(part)), np.repeat(counts[part, entry], width)]
            sums = pa.array([Decimal(int(x)) for x in totals[part, entry].ravel()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), sums], names=["part", "entry", "place", "n", "total"])

    found = rows.select("vector").mapInArrow(work, "part long, entry long, place long, n long, total decimal(38,0)")
    out = [b.astype(object) for b in books]
    for r in found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return [b.astype(exact_type(_largest(b), length)) for b in out]


def encode(rows: DataFrame, books: list[np.ndarray], length: int) -> DataFrame:
    """id, label, code (two hex digits a part) and error of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[type, list[VantageTree]] = {}
        for batch in batches:
            entries, squares = nearest_entries(integers(batch.column("vector"), length), shared.value, trees)
            raw = entries.astype(np.uint8).tobytes()
            codes = [raw[at : at + PARTS].hex() for at in range(0, len(raw), PARTS)]
            errors = [min(LONG, int(e)) for e in squares.sum(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(work, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def with_label_errors(coded: DataFrame, most: int = BROADCAST_LABELS) -> DataFrame:
    """The rows with ``label_error``, the error summed over equal labels. A label may hold any share of the rows: it is added up
    in parts first, and its one sum goes to the rows by a broadcast or, beyond ``most`` labels, by a join that can be split."""
    spark = coded.sparkSession
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = stored(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), shared_dir(spark))
    sums = F.broadcast(sums) if sums.count() <= most else sums.hint("rebalance")
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"])).drop("of")


def compress(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per kept vector: id, code, error, label_error, codebooks_sha256."""
    spark = session_of(vectors)
    rows, length = usable(vectors, id_, vector, label)
    if not length:
        return rows.where("false").select(F.col("id").alias(id_), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = first_entries(rows, length)
    for _ in range(ROUNDS):
        books = next_entries(rows, books, length)
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()
    coded = with_label_errors(stored(encode(rows, books, length), shared_dir(spark)))
    return coded.select(F.col("id").alias(id_), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    """The rounds one after the other, over rows of (vector, part)."""
    near = lambda books: f"""SELECT v.vec_id, v.label, v.part, v.a, v.b, v.c, v.d, min({{'d': (v.a - k.a) ** 2 + (v.b - k.b) ** 2 + (v.c - k.c) ** 2 + (v.d - k.d) ** 2, 'i': k.i}}) AS m
  FROM v JOIN {books} k ON v.part = k.part GROUP BY ALL"""  # noqa: E731
    floor = lambda x: f"(sum({x}) - ((sum({x}) % count(*)) + count(*)) % count(*)) // count(*)"
    means = lambda now: f"SELECT part, m.i AS i, {floor('a')} AS a, {floor('b')} AS b, {floor('c')} AS c, {floor('d')} AS d FROM {now} GROUP BY part, m.i"
    books = lambda old, new: f"SELECT o.part, o.i, {', '.join(f'CAST(coalesce(n.{x}, o.{x}) AS BIGINT) AS {x}' for x in 'abcd')} FROM {old} o LEFT JOIN {new} n ON n.part = o.part AND n.i = o.i"
    return f"""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS (SELECT vec_id, label, part, e[4 * part + 1] AS a, e[4 * part + 2] AS b, e[4 * part + 3] AS c, e[4 * part + 4] AS d FROM e, (SELECT unnest(range(16)) AS part)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM e ORDER BY vec_id LIMIT 64),
b0 AS (SELECT part, i, a, b, c, d FROM v JOIN first USING (vec_id)),
n0 AS ({near('b0')}), m0 AS ({means('n0')}), b1 AS ({books('b0', 'm0')}),
n1 AS ({near('b1')}), m1 AS ({means('n1')}), b2 AS ({books('b1', 'm1')}),
n2 AS ({near('b2')}),
coded AS (SELECT vec_id, label, string_agg(lower(printf('%02x', m.i)), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM n2 GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(a || ',' || b || ',' || c || ',' || d, ',' ORDER BY part, i)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books"""


QUERIES = {"op11_vector_codes": op11_vector_codes}
ORACLES = {"op11_vector_codes": _sql()}
