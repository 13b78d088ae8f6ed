import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cairn.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, c long, pos int, id string, part int, rank int, key string"
CLASHING = (1, 2, "x", 3, 4, "y")


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *CLASHING) for r in rows], SCHEMA).repartition(parts)


def brute(rows, rebuild):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = (abs(c) // 100 * 100) * (1 if c >= 0 else -1)
        convs[c] = own.get(base, [])[:h] + turns[h:] if rebuild else turns
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]].add(path)

    def under(path):
        found, todo = [], [path]
        while todo:
            at = todo.pop()
            found.append(at)
            todo += children[at]
        return found

    out = []
    for path, cs in members.items():
        below = under(path)
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(path))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(children[path]), sum(not children[p] for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, rebuild=True, size=ct.BLOCK, parts=3):
    got = [tuple(r) for r in ct.prefix_trie(frame(spark, rows, parts), ct.rebuilt if rebuild else None, size).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, rebuild), key=repr)
    return got


def random_rows(seed, convs, most, words=2):
    rng = random.Random(seed)
    return [(c, k, rng.choice(["user", "assistant"]), "é" * rng.randint(0, words)) for c in convs for k in range(rng.randint(1, most))]


def test_rebuilt_conversations(spark):
    check(spark, random_rows(1, [*range(0, 8), *range(95, 106), 250, 251, -3, -101, -100], 9))


@pytest.mark.parametrize("size", [2, 3])
def test_long_conversations_in_blocks(spark, size):
    rows = random_rows(5, range(12), 14, 1)
    check(spark, rows + [(100 + c, *r) for c, *r in rows if c < 6], rebuild=False, size=size)


def test_nulls_ties_repeats(spark):
    rows = [(1, None, "a", "x"), (1, None, None, None), (1, 0, "a", "y"), (1, 0, "a", "y"), (1, 0, "A", "y"), (None, 1, "a", "z"), (2, None, "a", "x"), (2, 5, None, "")]
    check(spark, rows, rebuild=False)
    check(spark, rows)


def test_roles_and_texts_do_not_run_together(spark):
    check(spark, [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "abc", "")], rebuild=False)


def test_turnless_and_copies(spark):
    shortest = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    check(spark, [(shortest, 0, "user", "gone")])
    check(spark, [(c, k, "user", "same") for c in range(300, 340) for k in range(3)] + [(7, 0, "user", "same")], rebuild=False)


def test_ids_that_end_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(ct, "PIECE_BYTES", 8)
    members = spark.createDataFrame([(r, c) for r in (1, 2) for c in range(-20, 40) if c % (r + 1)], "rank long, c long").repartition(5)
    for rank, digest in ct.ends(members).collect():
        assert digest == hashlib.sha256(",".join(str(c) for c in range(-20, 40) if c % (rank + 1)).encode()).hexdigest()


def test_one_conversation_over_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        check(spark, [(9, k, "user", f"t{k % 3}") for k in range(150)] + [(8, k, "user", f"t{k % 3}") for k in range(75)], rebuild=False, size=8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_table(spark):
    found = ct.prefix_trie(frame(spark, []), ct.rebuilt)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"] and found.count() == 0
    assert ct.prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
