import itertools

import numpy as np
import pytest

from cairn.llm import near_copies as x

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def brute(rows):
    """The ids that stay: the least of each component over pairs of Jaccard similarity 0.8 or more."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            lo, hi = sorted((root[a], root[b]))
            root = {i: lo if r == hi else r for i, r in root.items()}
    return sorted(set(root.values()))


def edited(text, places):
    words = text.split()
    for p in places:
        words[p] = f"changed{p}"
    return " ".join(words)


def corpus(prose):
    rows, n = [], 0
    for seed in range(30):
        base = prose(seed, 120)
        for k in range(4):  # k changed words, apart: (116 - 5k) / (116 + 5k) of the shingles are common
            rows.append((n, edited(base, range(10, 10 + 20 * k, 20))))
            n += 1
        rows.append((n, base.upper() + " "))
        n += 1
    return rows + [(n, None), (n + 1, " "), (n + 2, "three words only"), (n + 3, "Three words ONLY")]


def test_stage_finds_edited_copies(spark, docs, prose):
    rows = corpus(prose)
    got = corpus_pipeline.drop_near_copies(spark, docs(rows), "")
    assert sorted(r["doc_id"] for r in got.collect()) == brute(rows)


def test_groups_cut_into_blocks(docs, prose, tmp_path):
    base = prose(1, 150)
    rows = [(i, edited(base, [3 + 2 * i, 90 + i])) for i in range(40)] + corpus(prose)[:20]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    gone = x.verdicts(docs(rows), str(tmp_path), band_nodes=6, set_bytes=4000).where("NOT stay")
    assert sorted({i for i, _ in rows} - {r["doc_id"] for r in gone.collect()}) == brute(rows)


def test_links_of_real_sets():
    ten, nine, eight = (np.arange(k, dtype=np.uint64) for k in (10, 9, 8))
    empty = np.zeros(0, np.uint64)
    assert sorted(x.linked([ten, eight, nine + np.uint64(50)])) == [(0, 1)]
    assert x.linked([ten, np.arange(7, dtype=np.uint64)]) == [] and x.linked([empty, ten]) == []


def test_empty_table(docs):
    assert x.keep_one(docs([])).collect() == []


def test_linked_against_all_pairs():
    rng = np.random.default_rng(3)
    bases = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (0, 1, 9, 30)]
    for _ in range(60):
        sets = []
        for _ in range(int(rng.integers(1, 40))):
            base = bases[rng.integers(len(bases))]
            kept, more = base[rng.random(len(base)) < rng.choice([0.8, 0.9, 1])], rng.integers(0, 1 << 63, int(rng.integers(0, 4)))
            sets.append(np.unique(np.concatenate([kept, more.astype(np.uint64)])))
        pairs = []
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                common = len(np.intersect1d(a, b))
                if common >= x.SIMILARITY * (len(a) + len(b) - common) - 1e-9:
                    pairs.append((i, j))
        assert _roots(len(sets), x.linked(sets)) == _roots(len(sets), pairs)


def _roots(n: int, links: list[tuple[int, int]]) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return [find(x) for x in range(n)]
