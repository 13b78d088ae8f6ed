"""Near copies by the words themselves: shingle sets of Jaccard similarity 0.8 or more.

A text is the set of its runs of five words (ASCII lower case, cut at ASCII white
space); one of fewer words is a set of one run, a word-less one the empty set, and
empty sets equal each other. Texts of the same words are merged to one node.

Candidates come from two sides. The anchors of ``simhash`` link all texts whose
fingerprints over these runs differ in 3 bits or fewer; but a pair at 0.8 differs in
about ten bits, for which no covering code is small enough. So MinHash values in 24
bands of 4 bring together the rest: a pair at similarity 0.8 shares no band with
probability 3e-6, one at 0.9 with 4e-12. Nodes of a band are compared by 96 samples
of 4 bits, at a bound that a pair at 0.8 misses with probability 1e-7. Links are
folded to stars, so what leaves a task grows with the nodes and not with the pairs.
The groups found hold every pair to be tested; in each the real sets are compared,
and only pairs at 0.8 or more are links. Sets are built of the texts that a Bloom
filter of bounded size lets through; those without a candidate the join drops.

Groups above a bound, of a band or of sets, are cut into blocks and each pair of
blocks is compared in a group of its own; nothing is capped. Near copies of near
copies form one component, of which the row with the smallest (doc_id, digest of the
text) stays, a null doc_id after all others; of rows with one doc_id and text any one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import as_bytes, key_test, one_of_each, row_key, session_of, shared_dir, slices, stored
from cairn.llm.components import components
from cairn.llm.simhash import _fold, _shingle_hashes, majority, near_links
from cairn.session import remove_dir

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 4
#: Equal samples, of BANDS * BAND_ROWS, from which a pair of a band is looked at further.
LEAST_EQUAL = 58
#: Nodes of a band, and bytes of shingle sets, that are compared in one group.
BAND_NODES = 1 << 13
SET_BYTES = 32 << 20

_RNG = np.random.default_rng(7)
_XOR = _RNG.integers(0, 1 << 64, (BANDS * BAND_ROWS, 1), np.uint64)
_TIMES = _RNG.integers(0, 1 << 64, (BANDS * BAND_ROWS, 1), np.uint64) | np.uint64(1)
#: Equal halves of two bytes, by their exclusive or.
_EQUAL = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def shingle_set(words: list[bytes]) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of words."""
    return np.unique(_shingle_hashes(words, SHINGLE_WORDS))


def sketch(found: np.ndarray) -> tuple[list[int], bytes]:
    """The band values of a shingle set, and 4 bits of each MinHash value."""
    least = np.full(BANDS * BAND_ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(found), 1024):
        np.minimum(least, ((found[None, at : at + 1024] ^ _XOR) * _TIMES).min(axis=1), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    bands = np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64).view(np.int64).tolist()
    half = (least >> np.uint64(20)).astype(np.uint8) & 15
    return bands, (half[0::2] | half[1::2] << 4).tobytes()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        out: list[list] = [[], [], [], [], []]
        for raw in as_bytes(batch.column("text")):
            words = raw.lower().split()
            runs = _shingle_hashes(words, SHINGLE_WORDS)
            found = np.unique(runs)
            for held, v in zip(out, (hashlib.sha256(b" ".join(words)).digest(), *sketch(found), len(found), majority(runs)), strict=True):
                held.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("own"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.binary()), pa.array(out[3], pa.int64()), pa.array(np.array(out[4], np.uint64).view(np.int64))],
            names=["doc_id", "own", "words", "bands", "bits", "n", "fp"])


def _stars(group: np.ndarray, node: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group with enough equal samples, as stars around one node of each component."""
    label, at, step = np.arange(len(node)), np.arange(len(node)), 1
    while True:
        at = at[at + step < len(node)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        apart = at[label[at] != label[at + step]]
        for k in range(0, len(apart), 1 << 15):
            a = apart[k : k + (1 << 15)]
            near = a[_EQUAL[bits[a] ^ bits[a + step]].sum(axis=1) >= LEAST_EQUAL]
            if len(near):
                _fold(label, near, near + step)
        step += 1
    leaves = np.nonzero(label != np.arange(len(node)))[0]
    return node[leaves], node[label[leaves]]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), BANDS * BAND_ROWS // 2)


def _compare_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, node, bits = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, BANDS * BAND_ROWS // 2), np.uint8)

    def out(upto: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, _stars(group[:upto], node[:upto], bits[:upto]))), names=["u", "v"])

    for batch in batches:
        group = np.concatenate([group, batch.column("g").to_numpy()])
        node = np.concatenate([node, batch.column("node").to_numpy()])
        bits = np.concatenate([bits, _matrix(batch.column("bits"))])
        if len(group) and (whole := int(np.searchsorted(group, group[-1]))):
            yield out(whole)
            group, node, bits = group[whole:], node[whole:], bits[whole:]
    if len(group):
        yield out(len(group))


def _in_blocks(rows: DataFrame, weight, limit: int) -> DataFrame:
    """Rows of (g, node, ...) with groups of more than ``limit`` cut into blocks; each pair of blocks is a group.

    Groups of one row are left out: they have no pair.
    """
    counts = rows.groupBy("g").agg(F.count("*").alias("rows"), F.ceil(F.sum(weight) * 2 / limit).alias("blocks")).where("rows > 1")
    counts = counts.select("g", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")).cast("long").alias("blocks")).hint("rebalance")
    rest = [c for c in rows.columns if c != "g"]
    dealt = rows.join(counts, "g").withColumn("own_block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.xxhash64("g", F.least("own_block", "other"), F.greatest("own_block", "other"))
    return dealt.select(F.when(F.col("blocks") == 1, F.col("g")).otherwise(pair).alias("g"), *rest)


def _sets(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, own, found): the shingle sets of the texts whose ``own`` is among the ``keys``, and of few others."""
    passes = key_test(keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            batch = batch.filter(passes(batch.column("own")))
            found = [shingle_set(raw.lower().split()).tobytes() for raw in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("own"), pa.array(found, pa.binary())], names=["doc_id", "own", "found"])

    return texts.mapInArrow(work, "doc_id long, own binary, found binary")


def linked(sets: list[np.ndarray], least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links that join all sets of a component over pairs of similarity ``least`` or more.

    The lists of the sets that hold a run keep only sets not yet reached, and are cut anew each time half of those are gone.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column = np.unique(np.concatenate(sets), return_inverse=True) if len(owner) else (None, owner)
    width = column.max() + 1 if len(owner) else 0
    by_column = np.argsort(column, kind="stable")
    holders, held_column = owner[by_column], column[by_column]
    first = np.searchsorted(held_column, np.arange(width + 1))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    waiting, left, listed, links = np.ones(len(sets), bool), len(sets), len(sets), []
    for seed in range(len(sets)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        left -= 1
        front = [seed]
        while front and left:
            if 2 * left <= listed:
                keep = waiting[holders]
                holders, held_column, listed = holders[keep], held_column[keep], left
                first = np.searchsorted(held_column, np.arange(width + 1))
            a = front.pop()
            common = np.zeros(len(sets), np.int64)
            mine = column[begin[a] : begin[a + 1]]
            for at in range(0, len(mine), 1024):
                held = [holders[first[c] : first[c + 1]] for c in mine[at : at + 1024].tolist()]
                common += np.bincount(np.concatenate(held), minlength=len(sets))
            union = sizes + sizes[a] - common
            near = np.nonzero(waiting & (common >= least * union - 1e-9))[0]
            waiting[near] = False
            left -= len(near)
            links += [(a, int(b)) for b in near]
            front += near.tolist()
    return links


def _compare_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, held = None, {}

    def out() -> pa.RecordBatch:
        nodes, found = list(held), linked(list(held.values()))
        return pa.RecordBatch.from_arrays([pa.array([nodes[x[k]] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    for batch in slices(batches, "found"):
        for g, node, raw in zip(*(batch.column(c).to_pylist() for c in ("g", "node", "found")), strict=True):
            if g != now:
                if len(held) > 1:
                    yield out()
                now, held = g, {}
            held[node] = np.frombuffer(raw, np.uint64)
    if len(held) > 1:
        yield out()


def _by_group(rows: DataFrame, compare) -> DataFrame:
    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(compare, "u long, v long")


def _alike(nodes: DataFrame, folder: str) -> DataFrame:
    """Links of nodes whose fingerprints are linked: all of a fingerprint to its first node, and first nodes to each other."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    own = nodes.join(first.hint("rebalance"), "fp").where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    links = near_links(first, folder=folder).join(first.select(F.col("fp").alias("u"), F.col("first").alias("a")), "u").join(first.select(F.col("fp").alias("v"), F.col("first").alias("z")), "v")
    return own.unionByName(links.select(F.col("a").alias("u"), F.col("z").alias("v")))


def verdicts(docs: DataFrame, folder: str, band_nodes: int = BAND_NODES, set_bytes: int = SET_BYTES) -> DataFrame:
    """(doc_id, own, n, stay): each distinct id and text, how many rows have them, and whether it stays; ``own`` is the key of the text.

    What is read again lies below ``folder``.
    """
    session_of(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("own"), "text")
    prints = stored(texts.mapInArrow(_sketches, "doc_id long, own binary, words binary, bands array<long>, bits binary, n long, fp long"), folder)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "own")).alias("least")
    merged = prints.groupBy("words").agg(first, *[F.first(c).alias(c) for c in ("bands", "bits", "n", "fp")])
    nodes = stored(merged.withColumn("node", F.monotonically_increasing_id()), folder)

    dealt = _in_blocks(nodes.select(F.explode("bands").alias("g"), "node"), F.lit(1), band_nodes)  # bits follow only for groups of two or more
    near = _by_group(dealt.join(nodes.select("node", "bits"), "node").select("g", "node", "bits"), _compare_bits)
    groups = components(near.unionByName(_alike(nodes.select("fp", "node"), folder)), folder=folder)
    members = nodes.join(groups, "node").select(F.col("root").alias("g"), "node", "n", F.col("least.doc_id").alias("at_id"), F.col("least.own").alias("at_own"))
    members = stored(_in_blocks(members, F.col("n") * 8, set_bytes), folder)
    chosen = members.select("node", "at_id", "at_own").distinct()
    sets = _sets(texts, chosen.select(F.col("at_own").alias("own"))).join(chosen, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("own") == F.col("at_own")))
    sets = sets.select("node", "found").dropDuplicates(["node"])
    roots = components(_by_group(members.select("g", "node").join(sets, "node"), _compare_sets), folder=folder)

    rooted = nodes.join(roots, "node", "left").select("words", "least", F.coalesce("root", "node").alias("root"))
    stays = rooted.groupBy("root").agg(F.min("least").alias("stays")).hint("rebalance")
    verdict = rooted.select("words", "root").join(stays, "root").select("words", F.col("stays.doc_id").alias("stays_id"), F.col("stays.own").alias("stays_own"))
    rows = prints.groupBy("words", "doc_id", "own").agg(F.count("*").alias("n"))
    return rows.join(verdict.hint("rebalance"), "words").select("doc_id", "own", "n", (F.col("doc_id").eqNullSafe(F.col("stays_id")) & (F.col("own") == F.col("stays_own"))).alias("stay"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, one row of each component of near copies, with all their columns."""
    root = f"{shared_dir(docs.sparkSession)}/near-{uuid.uuid4().hex}"
    judged = stored(verdicts(docs, f"{root}/work").where("NOT stay OR n > 1"), root)
    remove_dir(docs.sparkSession, f"{root}/work")
    return one_of_each(docs, judged.where("NOT stay"), judged.where("stay"), filtered=True)
