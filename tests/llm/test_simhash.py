import itertools
import random
import re

import numpy as np
import xxhash

from cairn.llm import simhash as x
from cairn.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)) if h else 0


def brute_components(fps):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fps}


def test_fingerprint_of_whole_text(prose):
    for t in ["", " \n", "One", "One two", "one TWO three", "É a É a É", prose(1, 500), prose(2, 250_000), "x" * 3_000_000, "a " * 700_000]:
        assert x.fingerprint(t.encode()) == brute_fingerprint(t)


def test_every_close_pair_shares_an_anchor():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        near = []
        for v in (a, b):
            fps = np.array([v], np.uint64)
            near.append({(h, int(c)) for h in (0, 1) for c in x.anchors((fps >> np.uint64(32 * h)).astype(np.int64) & 0x7FFFFFFF)[1]})
        assert near[0] & near[1]


def test_components_against_brute_force(spark):
    rng = random.Random(2)
    fps = {0}
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):  # chains of small steps
            fps.add(v)
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << bit
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(i, signed(v)) for i, v in enumerate(sorted(fps))] + [(5000 + i, 0) for i in range(40)]
    ids = {v: i for i, v in enumerate(sorted(fps))}
    roots = brute_components(sorted(fps))
    least = {}
    for v in fps:
        least[roots[v]] = min(least.get(roots[v], 10**9), ids[v])
    found = {r["fp"]: r["component_id"] for r in x.near_components(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
    assert found == {signed(v): least[roots[v]] for v in fps}


def test_dense_cluster_is_cut_into_blocks(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(63)}
    for _ in range(250):
        fps.add(rng.choice(sorted(fps)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)))
    fps |= {rng.getrandbits(63) for _ in range(30)}
    df = spark.createDataFrame([(i, f) for i, f in enumerate(sorted(fps))], "doc_id long, fp long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert not x._links(df.select("fp").mapInArrow(x._replicate, "anchor long, fp long"), 3, 6).where("later").isEmpty()
        found = {r["fp"]: r["component_id"] for r in x.near_components(df, limit=6).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ids, roots = {f: i for i, f in enumerate(sorted(fps))}, brute_components(sorted(fps))
    assert found == {f: ids[roots[f]] for f in fps}


def test_dedup_cases(docs, prose):
    base = prose(3, 300)
    rows = [(5, base), (3, base.upper()), (9, base + " "), (4, None), (8, "   "), (7, "other words here"), (7, "other words here"), (None, base)]
    out = x.simhash_dedup(docs(rows)).collect()
    assert len(out) == len(rows)
    by = {(r["doc_id"], r["component_id"]) for r in out}
    assert by == {(5, 3), (3, 3), (9, 3), (4, 4), (8, 4), (7, 7), (None, 3)}
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in out)
    kept = x.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 7]


def test_empty_table(docs):
    assert x.simhash_dedup(docs([])).collect() == []


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 7)], "u long, v long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}
