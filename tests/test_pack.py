import random

from cairn.operators import retrieval


def greedy(rows, budget):
    out = {}
    for g, i, n in sorted(rows, key=lambda r: r[1]):
        total, ids = out.setdefault(g, (0, []))
        if n is not None and total + n <= budget:
            out[g] = total + n, [*ids, i]
    return out


def test_long_groups_are_packed_to_the_end(spark):
    rng = random.Random(1)
    rows = [("a", i, 1500 if i < 1 else rng.randint(600, 5000)) for i in range(3000)] + [("a", 3000, 400), ("a", 3001, 90), ("a", 3002, 0), ("a", 3003, 10)]
    rows += [("b", i, rng.choice([0, 1, 3, 7, 7, 50, None])) for i in range(4000, 6500)] + [("c", 7000, 9999), ("d", 7001, None)]
    rows += [("e", 8000 + i, 1990 - i) for i in range(1500)]
    rows += [(None, 9999, 5)]
    docs = spark.createDataFrame(rows, "source string, doc_id long, n long").repartition(5)
    got = {r["source"]: (r["total"], r["ids"]) for r in retrieval.pack(docs, ["source"], "doc_id", "n", "doc_id", 2000).collect()}
    assert got == greedy(rows, 2000) and got["a"] == (2000, [0, 3000, 3001, 3002, 3003])
