import itertools
import math
import random
import re

from cairn.llm import decontaminate as x


def words(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())


def brute(docs, items):
    found = set()
    for (d, t), (i, b) in itertools.product(docs, items):
        w, v = words(t), words(b)
        n = min(13, len(v))
        if n and any(sum(w[p + s + k] == v[s + k] for k in range(n)) >= 0.8 * n - 1e-9 for s in range(len(v) - n + 1) for p in range(-s, len(w) - n - s + 1) if p + s >= 0):
            found.add((d, i))
    return found


def test_masks_meet_every_placement():
    for gone in itertools.chain(*(itertools.combinations(range(13), k) for k in range(3))):
        assert any(all(at + k not in gone for k, bit in enumerate(m) if bit == "1") for m in x.MASKS for at in range(13 - len(m) + 1)), gone


def test_short_masks_meet_every_placement():
    for n in range(1, 13):
        changed = n - math.ceil(0.8 * n - 1e-9)
        masks = x.short_masks(n)
        assert all(len(m) == n for m in masks)
        for gone in itertools.combinations(range(n), changed):
            assert any(all(m[k] == "0" for k in gone) for m in masks), (n, gone)


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, doc_id int")


def made(prose):
    rng = random.Random(6)
    items = [(i, prose(100 + i, rng.randint(13, 40))) for i in range(12)] + [(50, "four little words here"), (51, None), (52, "..."), (50, "four little words here"), (53, prose(60, 200))]
    docs = []
    for d in range(60):
        v = words(rng.choice(items)[1]) or ["x"]
        for _ in range(rng.randint(0, 5)):
            v[rng.randrange(len(v))] = "changed"
        cut = rng.randint(0, len(v) // 2)
        docs.append((d, " ".join([prose(d, rng.randint(0, 30)), *v[cut:], prose(d + 500, 20)]).replace(" ", rng.choice([" ", ", ", "\n"]))))
    return docs + [(90, None), (91, ""), (92, "FOUR little, words-HERE."), (93, "four little words there"), (None, items[0][1]), (94, items[0][1]), (94, items[0][1]), (95, prose(1, 100_000) + " " + items[1][1])], items


def test_against_brute_force(spark, docs, prose):
    rows, items = made(prose)
    got = x.overlaps(docs(rows), benchmark(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(rows, items)
    for r in got:
        assert 0.5 <= r["equal_words"] / r["words"] <= 1


def test_short_items_with_substitutions(spark, docs, prose):
    rng = random.Random(8)
    items = [(n, prose(900 + n, n)) for n in range(1, 16)]
    rows = []
    for d in range(150):
        n, text = rng.choice(items)
        v = words(text)
        for k in rng.sample(range(n), rng.randint(0, n // 5 + 1) if n > 1 else 0):
            v[k] = "changed"
        rows.append((d, " ".join([prose(d, rng.randint(0, 9)), *v, prose(d + 500, rng.randint(0, 9))])))
    got = {(r["doc_id"], r["item_id"]) for r in x.overlaps(docs(rows), benchmark(spark, items)).collect()}
    assert got == brute(rows, items) and any(i in (10, 11, 12) for _, i in got)


def test_one_hot_seed(spark, docs, prose):
    common = prose(42, 20)
    items = [(i, common + " " + prose(2000 + i, 5)) for i in range(30)]
    rows = [(d, prose(d, 4) + " " + common) for d in range(80)] + [(500, prose(1, 50))]
    got = x.overlaps(docs(rows), benchmark(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, i) for d in range(80) for i in range(30)} and len(got) == 2400


def test_long_texts_are_cut_between_words(monkeypatch):
    texts = [b"one two, three " * 50, b"", b"word" * 200 + b" x", "\u00e9t\u00e9 SUMMER ".encode() * 30]
    whole = x.word_hashes(texts)
    monkeypatch.setattr(x, "_SLICE", 37)
    cut = x.word_hashes(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_remove_keeps_columns_and_clean_documents(spark, docs, prose):
    rows, items = made(prose)
    rows = [r for r in rows if r[0] != 95] + [(200, "other words"), (200, items[1][1])]
    d, size = docs(rows), {i: len(words(t)) for i, t in items}
    hits = brute([(t, t) for t in {t for _, t in rows}], items)
    for least in (1, x.LEAST_WORDS):
        bad = {t for t, i in hits if size[i] >= least}
        kept = x.remove_contaminated(d, benchmark(spark, items), least_words=least)
        assert kept.columns == d.columns
        assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(((i, t) for i, t in rows if t not in bad), key=str)


def test_empty_tables(spark, docs):
    assert x.overlaps(docs([]), benchmark(spark, [(1, "a b c")])).collect() == []
    assert x.overlaps(docs([(1, "a b c")]), benchmark(spark, [])).collect() == []
    assert x.remove_contaminated(docs([(1, "a b c")]), benchmark(spark, [])).count() == 1
