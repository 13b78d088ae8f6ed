import hashlib
import re
import tempfile

import pytest

from cairn.llm import exact_dedup as x


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0d]", "", t or "")
        keep = min(groups[key], key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return out


CASES = {
    "mixed": [(1, "a b"), (2, "ab"), (3, " a  b"), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r"), (7, "a b"), (8, "é x"), (9, "éx"), (9, "éx"), (None, "a b"), (None, "z")],
    "long": [(1, "word " * 200_000), (2, "word" * 200_000), (3, "w")],
    "hot": [(i, "same text") for i in range(300)] + [(1000 + i, f"own {i}") for i in range(50)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("budget", [x.TABLE_BYTES, 600])
def test_against_brute_force(docs, name, budget):
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r)
    assert sorted(map(tuple, x.exact_dedup(docs(CASES[name]), budget).collect()), key=key) == sorted(brute(CASES[name]), key=key)


def test_empty_table(docs):
    assert x.exact_dedup(docs([])).collect() == []


def test_keep_one_has_all_columns(docs):
    d = docs([(1, "a b"), (2, "ab"), (3, "c"), (None, "ab")])
    kept = x.keep_one(d)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_recursion_compares_whole_contents():
    same_digest = hashlib.sha256(b"").digest()
    records = [[same_digest, b"%d" % (i % 40) * 50, i, i, 1] for i in range(200)]
    with tempfile.TemporaryDirectory() as folder:
        found = {e[1]: (e[3], e[4]) for e in x.grace(iter(records), 2000, folder)}
    assert found == {b"%d" % k * 50: (160 + k, 5) for k in range(40)}
