import hashlib
import math
import random

import numpy as np
import pytest

from cairn.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, id string, vector int, code int, part int, error string"
CLASHING = ("x", 1, 2, 3, "y")


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *CLASHING) for r in rows], SCHEMA).repartition(parts)


def brute(rows):
    """(vec_id, code, error, label_error, digest) of each kept row, step by step in Python's integers."""
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    if not good:
        return []
    sizes = [len(r[1]) for r in good]
    length = max(set(sizes), key=lambda n: (sizes.count(n), n))
    good = [r for r in good if len(r[1]) == length]
    most = 1 << 62
    whole = lambda v: [max(-most, min(most, math.floor(x * 256))) for x in v] + [0] * (-length % 16)
    vectors = [(r[0], whole(r[1]), r[2]) for r in good]
    width = len(vectors[0][1]) // 16
    first = [v for _, v, _ in sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]]
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(16)]
    books = [[cut(v)[p] for v in first] for p in range(16)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda: [[min((gap(part, e), i) for i, e in enumerate(books[p])) for p, part in enumerate(cut(v))] for _, v, _ in vectors]
    for _ in range(2):
        found = near()
        for p in range(16):
            for i in range(len(first)):
                own = [cut(v)[p] for (_, v, _), f in zip(vectors, found, strict=True) if f[p][1] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    rest = [(i, "".join(f"{k:02x}" for _, k in f), min((1 << 63) - 1, sum(d for d, _ in f)), label) for (i, _, label), f in zip(vectors, near(), strict=True)]
    return [(i, code, e, min((1 << 63) - 1, sum(x for _, _, x, m in rest if m == label)), digest) for i, code, e, label in rest]


def check(spark, rows):
    got = [tuple(r) for r in vc.compress(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    return got


def random_rows(seed, n, length, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(length)], rng.choice([None, 0, 1, 2])) for i in range(n)]


@pytest.mark.parametrize(("n", "length"), [(1, 16), (40, 32), (150, 32), (130, 40)])
def test_against_brute_force(spark, n, length):
    assert len(check(spark, random_rows(n, n, length))) == n


def test_ties_repeats_and_equal_entries(spark):
    rng = random.Random(4)
    few = [[rng.choice([-1.0, 0.0, 0.5]) for _ in range(32)] for _ in range(5)]
    check(spark, [(i // 2 if i % 7 else None, few[i % 5], i % 3) for i in range(160)])


def test_rows_that_are_dropped(spark):
    rows = random_rows(9, 30, 32)
    bad = [(100, None, 1), (101, [], 1), (102, [None] * 32, 1), (103, [math.nan] * 32, 0), (104, [math.inf] + [0.0] * 31, 0), (105, [1.0] * 16, 0)]
    assert {r[0] for r in check(spark, rows + bad)} == set(range(30))


def test_very_large_components(spark):
    rows = random_rows(3, 70, 16) + random_rows(5, 20, 16, 1e6) + [(500, [1e300] + [0.0] * 15, 7), (501, [-1e12] * 16, 7), (502, [3e38] * 16, 8)]
    check(spark, rows)


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1)], [(1, [math.nan], 1)]):
        found = vc.compress(frame(spark, rows))
        assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and found.count() == 0


def test_labels_by_a_join_give_the_same(spark):
    coded = spark.createDataFrame([(i, i % 4 or None, "c", i) for i in range(50)], "id long, label int, code string, error long")
    same = lambda most: sorted(map(tuple, vc.with_label_errors(coded, most).collect()))
    assert same(0) == same(100)


@pytest.mark.parametrize("kind", [np.int64, object])
def test_tree_finds_the_lowest_nearest_entry(kind):
    rng = np.random.default_rng(2)
    for k, reach in ((1, 3), (9, 1), (64, 2), (64, 1000)):
        entries, rows = (rng.integers(-reach, reach + 1, (n, 4)).astype(kind) for n in (k, 500))
        found, least = vc.VantageTree(entries).nearest(rows)
        squares = vc._squares(rows, entries)
        assert (found == squares.argmin(axis=1)).all() and (least == squares.min(axis=1)).all()
