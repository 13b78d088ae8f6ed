import hashlib
import random
from collections import Counter

import pytest

from cairn.llm import suffix_dedup as x


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        covered = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                covered[p : p + length] = [True] * length
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        out.append((i, len(t), sum(covered), sum(c and (k == 0 or not covered[k - 1]) for k, c in enumerate(covered)), hashlib.sha256(kept).hexdigest(), kept))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[5]))


def random_rows(seed, n):
    rng = random.Random(seed)
    words = ["ab", "cde", "fg", "é", "hijk", "\n", "日本"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 3)
            parts.append(rng.choice([p, p[cut:], p[: len(p) - cut], " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))]))
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(docs, seed):
    rows = random_rows(seed, 60)
    assert order(map(tuple, x.remove_repeats(docs(rows), length=40, gram=12).collect())) == order(brute(rows, 40))


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_passages_give_the_same(docs, hot):
    rows = random_rows(4, 50)
    assert order(map(tuple, x.remove_repeats(docs(rows), length=40, gram=12, hot_places=hot).collect())) == order(brute(rows, 40))


@pytest.mark.parametrize("hot", [0, x.HOT_PLACES])
def test_hard_cases(docs, hot):
    line = "the same long line over and over "
    rows = [(1, None), (2, ""), (3, "short"), (4, "a" * 500), (5, line * 60), (6, "abc" * 10 + line * 3 + "z" * 50), (7, "x" * 39), (7, "x" * 39),
            (8, "copy me whole, all of these forty bytes and more"), (9, "copy me whole, all of these forty bytes and more"), (9, "copy me whole, all of these forty bytes and more"), (None, "é" * 30)]
    assert order(map(tuple, x.remove_repeats(docs(rows), length=40, gram=12, hot_places=hot).collect())) == order(brute(rows, 40))


def test_very_long_text_in_pieces(monkeypatch, prose):
    monkeypatch.setattr(x, "_PIECE", 1000)
    text = prose(4, 2000).encode()
    whole = x.sample([text], 40, 12)
    monkeypatch.setattr(x, "_PIECE", 1 << 20)
    assert {(m, w) for m, p, q in zip(*[a.tolist() for a in whole[1:4]], strict=True) for w in range(p, q + 1)} == {
        (m, w) for m, p, q in zip(*[a.tolist() for a in x.sample([text], 40, 12)[1:4]], strict=True) for w in range(p, q + 1)}


def test_empty_table(docs):
    assert x.remove_repeats(docs([])).collect() == []


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(5)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        merged = list(x.merge_runs([x.decode_run(*x.encode_run(r)) for r in runs]))
        assert [m[1] for m in merged] == sorted(s for r in runs for s in r)
        before = b""
        for _, s, p in merged:
            assert p == x.common_prefix(before, s, 0)
            before = s


def test_prefix_is_counted_from_the_known_part():
    assert x.common_prefix(b"abcx", b"abcy", 2) == 3 and x.common_prefix(b"abc", b"abcy", 3) == 3 and x.common_prefix(b"", b"a", 0) == 0


def test_hot_grams_share_the_pass_over_the_texts(docs, monkeypatch, tmp_path):
    passes, texts = [], x._texts
    monkeypatch.setattr(x, "_texts", lambda d: passes.append(1) or texts(d))
    assert x.repeated_spans(docs(random_rows(6, 40)), str(tmp_path), 40, 12, hot_places=3).count() > 0
    assert (tmp_path / "windows").exists() and len(passes) == 1


def test_filter_keeps_every_gram(spark):
    rng = random.Random(7)
    grams = [(rng.randrange(-(1 << 63), 1 << 63),) for _ in range(500)]
    frame = spark.createDataFrame(grams, "gram long")
    others = spark.createDataFrame([(rng.randrange(-(1 << 63), 1 << 63),) for _ in range(5000)], "gram long")
    assert frame.where(x._may_have(frame, 500)).count() == 500 and others.where(x._may_have(frame, 500)).count() < 500


def test_planted_passages_and_clean_documents(docs, prose):
    """Passages of over 50 words and at least 400 bytes in two documents each go, and nothing of the others."""
    passage = {k: prose(100 + k, 80) for k in range(5)}
    assert all(len(p) >= 400 for p in passage.values())
    rows = [(i, f"{prose(i, 60)} {passage[i // 2]} {prose(200 + i, 60)}") for i in range(10)] + [(i, prose(i, 150)) for i in range(50, 60)]
    found = {r.doc_id: r.n_removed for r in x.remove_repeats(docs(rows), with_text=False).collect()}
    assert all(found[i] >= len(passage[i // 2]) for i in range(10)) and not any(found[i] for i in range(50, 60))


def test_query_on_the_given_table(spark):
    """At the contract's 400 bytes; n_bytes is the whole text's length, whatever was removed."""
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = x.QUERIES["op1_suffix_dedup"](spark, sf_dir)
    assert found.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    wanted = [r[:5] for r in brute(rows, 400)]
    assert any(r[2] for r in wanted) and sorted(tuple(r[:5]) for r in found.collect()) == sorted(wanted)
