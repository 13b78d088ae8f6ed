import math
import random
import re
from collections import Counter

from cairn.llm import toxicity as x


def made(prose, n=400):
    rng, docs, labels = random.Random(3), [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(i, 40).split()
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "loser", "scum", "zorgle", "l0ser"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def frame(spark, rows):
    return spark.createDataFrame([(i, 1, t) for i, t in rows], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs, prose):
    rows, labels = made(prose)
    rows += [(900, None), (901, ""), (902, "you idiot " * 50_000), (903, "IDIOT!!! you l.o.s.e.r"), (903, "IDIOT!!! you l.o.s.e.r"), (None, "plain")]
    got = x.score(docs(rows), frame(spark, [*labels, (0, 0), (5, None), (None, 1)])).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    import zlib

    held = [(r["score"], dict(labels)[r["doc_id"]]) for r in got if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum((s >= x.THRESHOLD) == bool(t) for s, t in held) / len(held) > 0.95
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[901] < x.THRESHOLD < by[902]


def test_features():
    marks = x.Marks({"loser": 2.0})
    f = dict(zip(x.FEATURES, x.text_features("You LOSER! nothing else l0s3r loooser", marks), strict=True))
    assert f["lexicon"] == 1 / 6 and f["hidden"] == 2 / 6 and f["near_you"] > 0 and f["caps_words"] == 1 / 6 and f["stretched"] == 1 / 6 and f["exclamation"] > 0
    assert all(v == 0 for v in x.text_features("", marks))


def test_without_both_labels(spark, docs):
    assert x.score(docs([]), frame(spark, [])).collect() == []
    assert [r["score"] for r in x.score(docs([(1, "a")]), frame(spark, [])).collect()] == [0.0]
    assert {r["score"] for r in x.score(docs([(i, "a") for i in range(40)]), frame(spark, [(i, 1) for i in range(40)])).collect()} == {1.0}


def plain_features(text, weights):
    """The features worked out word by word."""
    words, n = text.split(), max(1, len(text.split()))
    leet = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "@": "a", "$": "s", "!": "i", "7": "t"}
    core = lambda w: re.sub(r"^\W+|\W+$", "", w)
    kind, weight = [], []
    for w in words:
        found, k = weights.get(core(w).lower()), "lexicon"
        if found is None:
            bare, k = re.sub(r"[^\w]|_", "", "".join(leet.get(c, c) for c in w.lower())), "hidden"
            for form in (bare, re.sub(r"(.)\1\1+", r"\1", bare), re.sub(r"(.)\1\1+", r"\1\1", bare)):
                if form != core(w).lower() and form in weights:
                    found = weights[form]
                    break
        kind.append(k if found is not None else None)
        weight.append(int(min(99, max(0, found)) * 100) / 100 if found is not None else 0)
    you = [core(w).lower() in x.SECOND_PERSON for w in words]
    near = sum(any(you[max(0, i - 4) : i + 5]) for i, k in enumerate(kind) if k)
    raw, lex, hid = text.encode(), kind.count("lexicon"), kind.count("hidden")
    size, count = max(1, len(raw)), Counter(raw)
    upper, lower = sum(count[c] for c in range(65, 91)), sum(count[c] for c in range(97, 123))
    marks = sum(count[c] for c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    inner = re.compile(r"\w[^\w\s'\u2019-]+\w|[A-Za-z]\d+[A-Za-z]|[A-Za-z][*_.-][A-Za-z][*_.-]")
    return [
        lex / n, math.log1p(lex), sum(weight) / n, math.log1p(len({w.lower() for w, k in zip(words, kind, strict=True) if k})), hid / n, math.log1p(hid), near / n, math.log1p(near), sum(you) / n,
        sum(len(core(w)) > 1 and core(w).isupper() for w in words) / n, upper / max(1, upper + lower), count[33] / size, count[63] / size, marks / size,
        sum(bool(inner.search(core(w))) for w in words) / n, sum(bool(re.search(r"(.)\1\1", core(w))) for w in words) / n, sum(count[c] for c in range(48, 58)) / size, math.log1p(len(words)),
    ]


def test_features_word_by_word(spark, docs):
    rng, weights = random.Random(9), {"loser": 2.0, "idiot": 1.25, "scum": 0.5, "zorgle": 120.0}
    pool = ["You", "you", "LOSER!", "l0ser", "loooser", "idiot,", "(IDIOT)", "s.c.u.m", "scum", "zorgle", "zzzorgle", "plain", "Words", "OK", "a1b", "d.o.t.s", "été", "--", "7", "why?", "no!!", "it's", "don’t"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(120)] + [(500, None)]
    got = {r["doc_id"]: r for r in x.features(docs(rows), weights).collect()}
    for i, text in rows:
        assert all(abs(got[i][f] - v) < 1e-9 for f, v in zip(x.FEATURES, plain_features(text or "", weights), strict=True)), text


def test_lexicon_and_calibration_by_plain_counts(spark):
    rng = random.Random(5)
    pool = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(500)]
    rows = [(" ".join([*rng.choices(pool[:350] if t else pool, k=60), *(["vermin"] if t and rng.random() < 0.7 else []), "Coward." if not t else "x1"]), t) for t in (int(i % 3 == 0) for i in range(300))]
    yes, no = Counter(), Counter()
    for text, t in rows:
        (yes if t else no).update({w for w in (re.sub(r"^\W+|\W+$", "", v).lower() for v in text.split()) if w.isalpha()})
    odds = {}
    for w in {*yes, *no}:
        if yes[w] + no[w] >= x.LEARNED_LEAST:
            k, m = yes[w] + 0.5, no[w] + 0.5
            odds[w] = math.log(k / 101) - math.log(m / 201) - 1.96 * math.sqrt(1 / k + 1 / m)
    expected = {w: 1.0 for w in x.INSULTS if odds.get(w, 1) >= x.LEARNED_ODDS} | {w: o for w, o in odds.items() if o >= x.LEARNED_ODDS}
    got = x.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int").repartition(3))
    assert got.keys() == expected.keys() and all(abs(got[w] - expected[w]) < 1e-9 for w in got) and "vermin" in got and "coward" not in got

    pairs = sorted((round(rng.random(), 3), int(rng.random() < 0.4)) for _ in range(400))
    blocks = []  # pool adjacent violators over equal scores
    for score in sorted({s for s, _ in pairs}):
        own = [t for s, t in pairs if s == score]
        blocks.append([sum(own), len(own), [score]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    expected = {s: b[0] / b[1] for b in blocks for s in b[2]}
    df = spark.createDataFrame([(s, t) for s, t in pairs], "raw double, toxic int")
    for r in x.calibration(df).transform(df).collect():
        assert abs(r["calibrated"] - expected[r["raw"]]) < 1e-9


def test_more_words_than_a_short_list_are_learned(spark):
    bad = ["q" + "".join(chr(97 + (k // 26**d) % 26) for d in range(3)) for k in range(700)]
    rows = [(" ".join(bad), 1)] * 40 + [("fine words only", 0)] * 40
    assert set(bad) <= set(x.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int")))


def test_long_words_are_not_remembered():
    marks = x.Marks({"idiot": 1.0})
    assert marks["x" * 1000] == marks["x" * 1000] and marks["IDIOT"] == marks["IDIOT"] and set(marks) == {"IDIOT"}
