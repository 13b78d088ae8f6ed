import numpy as np

from cairn.llm import language_id as x

A, B = ("ka", "lo", "mi", "ra"), ("stro", "weg", "thu", "pfen")


def corpus(prose, n=60):
    return [(i, prose(i, 40, A if i % 2 else B), "aa" if i % 2 else "bb") for i in range(n)]


def test_marginals_are_those_of_one_pass():
    rng = np.random.default_rng(1)
    move = rng.normal(size=(3, 3)).astype(np.float32)
    sizes = np.array([1, 5, 0, 64, 65, 400, 128])
    scores = rng.normal(size=(sizes.sum(), 3)).astype(np.float32) * 3
    found, at, step = x.marginals(scores, sizes, move), 0, np.exp(move.astype(float))
    for n in sizes[sizes > 0]:
        local = np.exp(scores[at : at + n].astype(float))
        f, b = np.ones((n, 3)), np.ones((n, 3))
        for i in range(n):
            f[i] = local[i] * (f[i - 1] @ step if i else 1)
            f[i] /= f[i].sum()
        for i in range(n - 2, -1, -1):
            b[i] = step @ (local[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
        expected = f * b / (f * b).sum(1, keepdims=True)
        assert np.abs(expected - found[at : at + n]).max() < 1e-4
        at += n


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    scores, move = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)) * 0.3
    gold = rng.integers(0, 3, (2, 4))

    def likelihood(s, m):
        total = 0.0
        for row, g in zip(s, gold, strict=True):
            alpha = row[0]
            for i in range(1, 4):
                alpha = row[i] + np.log(np.exp(alpha[:, None] + m).sum(0))
            total += row[np.arange(4), g].sum() + m[g[:-1], g[1:]].sum() - np.log(np.exp(alpha).sum())
        return total

    grad, pairs = x._gradient(scores, gold, move)
    for idx in ((0, 0, 1), (1, 3, 2), (1, 2, 0)):
        d = np.zeros_like(scores)
        d[idx] = 1e-5
        assert abs((likelihood(scores + d, move) - likelihood(scores - d, move)) / 2e-5 - grad[idx]) < 1e-4
    d = np.zeros_like(move)
    d[0, 2] = 1e-5
    assert abs((likelihood(scores, move + d) - likelihood(scores, move - d)) / 2e-5 - pairs[0, 2]) < 1e-3


def test_held_out_accuracy_and_code_switching(docs, prose):
    rows = corpus(prose)
    model = x.fit([t.encode() for _, t, _ in rows], [c for *_, c in rows])
    test = [prose(900 + i, 30, A if i % 2 else B) for i in range(40)]
    found, score, _ = x.label_texts(model, [t.encode() for t in test])
    assert sum(f == ("aa" if i % 2 else "bb") for i, f in enumerate(found)) >= 39
    mixed = (prose(1, 30, A) + " " + prose(2, 30, B)).encode()
    words = x.Words([mixed])
    labels = x.marginals(model.emissions(words), np.array([60]), model.transitions).argmax(1)
    assert (labels[:28] == 0).mean() > 0.9 and (labels[32:] == 1).mean() > 0.9


def test_rows(docs, prose):
    rows = corpus(prose) + [(900, None, "aa"), (901, "", None), (902, "123 !!! —", "bb"), (903, prose(5, 30, A), None), (903, prose(5, 30, A), None), (None, prose(6, 30, B), "bb"), (904, prose(7, 300_000, A), "aa")]
    got = x.identify(docs(rows)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert (by[900], by[901], by[902], by[903], by[None], by[904]) == ("und", "und", "und", "aa", "bb", "aa")
    kept = x.keep_identified(docs(rows))
    assert kept.columns == docs(rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, *_ in rows} - {900, 901, 902}


def test_without_labels(docs):
    assert x.identify(docs([])).collect() == []
    assert [(r["lang_pred"], r["score"]) for r in x.identify(docs([(1, "words", None)])).collect()] == [("und", 0.0)]


def test_every_language_is_learned_and_mixed_texts_stay(docs, prose):
    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(70)]
    sound = {n: (n + "ko", n[::-1] + "tu", n + n) for n in names}
    rows = [(100 * k + j, prose(1000 * k + j, 60, sound[n]), n) for k, n in enumerate(names) for j in range(6)]
    model = x.learn(docs(rows))
    assert model.languages == names
    mixed = " ".join(prose(5000 + k, 25, sound[names[k]]) for k in range(5))
    assert x.label_texts(model, [mixed.encode()])[1][0] < 0.4
    assert x.keep_identified(docs([(1, mixed, None)]), model).count() == 1


def test_pieces_change_nothing(prose, monkeypatch):
    rows = corpus(prose)
    model = x.fit([t.encode() for _, t, _ in rows], [c for *_, c in rows])
    texts = [prose(1, 300, A).encode(), b"", "Été ÉTÉ ".encode() * 50 + prose(2, 60, B).encode(), b"1 2 3"]
    whole = x.label_texts(model, texts)
    monkeypatch.setattr(x, "_SLICE", 50)
    cut = x.label_texts(model, texts)
    assert whole[0] == cut[0] and np.allclose(whole[1], cut[1]) and np.allclose(whole[2], cut[2])


def test_every_language_is_learned(spark, docs, prose):
    """Languages of long texts alone, and of one text among very many, are learned too."""
    rows = [(k, prose(k, 20, ("ka", "lo", "mi")), "aa") for k in range(300)]
    rows += [(1000 + k, prose(k, 30_000, ("stro", "weg")), "bb") for k in range(4)]
    rows += [(2000 + k, prose(k, 20, ("thu", "pfen")), "cc") for k in range(4)]
    model = x.learn(docs(rows), sample_rows=3)
    assert model.languages == ["aa", "bb", "cc"]
    assert x.label_texts(model, [prose(9, 20, ("stro", "weg")).encode(), prose(9, 20, ("thu", "pfen")).encode()])[0] == ["bb", "cc"]


def test_last_rows_of_the_sample_without_words(spark, docs, prose):
    rows = corpus(prose) + [(9001, "12 34", "aa"), (9002, "", "bb"), (9003, "", "aa"), (9004, "!", "cc"), (9005, "", "bb"), (9006, "", "bb")]
    found = {r["doc_id"]: r["lang_pred"] for r in x.identify(docs(rows)).collect()}
    assert all(found[i] == lang for i, _, lang in rows[:60]) and {found[i] for i in range(9001, 9007)} == {"und"}
