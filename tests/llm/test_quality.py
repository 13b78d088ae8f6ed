import random
import zlib

import numpy as np
import pytest

from cairn.llm import quality as q

LABELS = "doc_id long, quality int, toxic int"


def plain_contexts(streams):
    vectors = q.index_vectors().astype(int)
    sums, counts = np.zeros((q.BUCKETS, q.DIM), int), np.zeros(q.BUCKETS, int)
    for stream in streams:
        for i, b in enumerate(stream):
            counts[b] += 1
            for j in range(max(0, i - q.WINDOW), min(len(stream), i + q.WINDOW + 1)):
                if j != i:
                    sums[b] += vectors[stream[j]]
    return sums, counts


def plain_runs(text):
    """(is a word, folded bytes, in capitals) of each run, byte by byte."""
    raw, out, at = text.encode(), [], 0
    word = lambda i: 0 <= i < len(raw) and (raw[i] >= 128 or chr(raw[i]).isalnum())
    kind = lambda i: 0 if raw[i] in b" \t\n\x0b\x0c\r" else 1 if word(i) or raw[i] in b"'-" and word(i - 1) and word(i + 1) else 2
    while at < len(raw):
        to = at
        while to < len(raw) and kind(to) == kind(at):
            to += 1
        run = raw[at:to]
        letters = [c for c in run if c < 128 and chr(c).isalpha()]
        if kind(at):
            out.append((kind(at) == 1, run.lower(), kind(at) == 1 and len(letters) > 1 and all(chr(c).isupper() for c in letters)))
        at = to
    return out


def plain_hash(is_word, run):
    value = sum((c + 1) * pow(q._FACTOR, i, 1 << 64) for i, c in enumerate(run)) + (1 if is_word else 2) * int(q._OF_KIND)
    return int(q._buckets(np.array([value % (1 << 64)], np.uint64))[0])


def plain_tokens(text):
    out, last = [], None
    for is_word, run, capitals in plain_runs(text):
        out += [int(q._CAPITALS)] * capitals + [plain_hash(is_word, run)] + [int(q._AGAIN)] * (is_word and run == last)
        last = run if is_word else last
    return out


TEXT = "One one, TWO!! two two-three ***  don't 'x' - A AB É ÉÉ under_score 1A\n\n" * 30 + "x" * 300 + " END"


def test_streams_against_plain_loops():
    texts = [TEXT, "", " \n", "same", "same", "same same", "A-B c--d", "-", "é-É", TEXT]
    assert [s.tolist() for s in q.streams([t.encode() for t in texts])] == [plain_tokens(t) for t in texts]
    assert q.streams([]) == []


def test_streams_in_pieces_are_those_of_the_whole(monkeypatch):
    texts = [t.encode() for t in ("short", TEXT, "", "END again again", TEXT[:500], "x")]
    whole = [s.tolist() for s in q.streams(texts)]
    for size in (400, 1000, 5000):
        monkeypatch.setattr(q, "PIECE", size)
        assert [s.tolist() for s in q.streams(texts)] == whole


def test_a_word_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(q, "PIECE", 64)
    assert [len(s) > 0 for s in q.streams([b"y" * 1000, b"z"])] == [True, True]


@pytest.mark.parametrize("together", [3, 5, 1000])
def test_contexts_against_plain_loops(monkeypatch, together):
    monkeypatch.setattr(q, "TOKENS", together)
    rng = random.Random(3)
    streams = [np.array([rng.randint(1, 9) for _ in range(n)], np.uint16) for n in (0, 1, 2, 30, 5)]
    sums, counts = np.zeros((q.BUCKETS, q.DIM), np.int64), np.zeros(q.BUCKETS, np.int64)
    apart = np.zeros(q.WINDOW, np.uint16)
    q.add_contexts(np.concatenate([x for s in streams for x in (s, apart)]), q.WINDOW, q.index_vectors(), sums, counts)
    counts[0] = 0
    expected, n = plain_contexts(streams)
    assert (counts == n).all() and (sums[1:] == expected[1:]).all()


def test_word_vectors_of_a_table(spark, docs, prose):
    texts = [prose(k, 30) for k in range(20)] + [None, "", prose(1, 30)]
    got = q.word_vectors(docs(list(enumerate(texts)), 4)).values
    expected = q.Vectors.of(*plain_contexts([plain_tokens(t or "") for t in texts])).values
    assert np.array_equal(got, expected)


def test_pooling_against_plain_moments(monkeypatch):
    monkeypatch.setattr(q, "TOKENS", 4)
    rng = np.random.default_rng(1)
    vectors = q.Vectors(rng.normal(size=(q.BUCKETS, q.DIM)).astype(np.float32))
    stream = rng.integers(1, q.BUCKETS, 11).astype(np.uint16)
    own = vectors.values[stream].astype(np.float64)
    assert np.allclose(vectors.pooled(stream), np.concatenate([own.mean(0), own.std(0), [np.log(12)]]), atol=1e-5)
    assert not vectors.pooled(stream[:0]).any()


def test_slopes_against_differences():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(7, 4)), rng.integers(0, 2, 7).astype(float)
    weights = [rng.normal(size=(4, 3)), rng.normal(size=3), rng.normal(size=3), rng.normal(size=1)]

    def loss():
        raw = np.tanh(x @ weights[0] + weights[1]) @ weights[2] + weights[3][0]
        return q.log_loss(raw, y) + q.DECAY / 2 * ((weights[0] ** 2).sum() + (weights[2] ** 2).sum())

    for w, slope in zip(weights, q.slopes(x, y, weights), strict=True):
        for at in np.ndindex(w.shape):
            kept, w[at] = w[at], w[at] + 1e-6
            up = loss()
            w[at] = kept - 1e-6
            down, w[at] = loss(), kept
            assert abs((up - down) / 2e-6 - slope[at]) < 1e-6


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 2))
    y = (rng.random(300) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = q.Network(np.zeros(2), np.ones(2), (np.array([[1.0], [0.0]]), np.zeros(1), np.array([9.0]), np.zeros(1)))
    net.calibrate(x, y)
    losses = {t: q.log_loss(net.raw(x) / t, y) for t in np.exp(np.linspace(-3, 3, 601))}
    assert abs(np.log(net.temperature) - np.log(min(losses, key=losses.get))) < 0.02 and net.temperature > 1


def labelled(spark, prose, n=240):
    """Rows of junk (0) and prose (1), and their labels."""
    rows = [(k, " ".join(w + "&&&" for w in prose(k, 25).split()) if k % 4 == 0 else prose(k, 30)) for k in range(n)]
    return rows, [(k, int(k % 4 != 0), 0) for k in range(n)]


def test_held_out_rows_and_cases(spark, docs, prose):
    rows, labels = labelled(spark, prose)
    extra = [(900, None), (901, ""), (None, "words"), (902, "a" * 5000), (3, rows[3][1]), (3, "another text")]
    found = q.score(docs(rows + extra), spark.createDataFrame([*labels, (None, 0, 0), (5, None, 0), (1, 0, 0)], LABELS)).collect()
    assert len(found) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 240 and r["doc_id"] != 3 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 20 and all((r["score"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in held)
    empty = {r["score"] for r in found if r["doc_id"] in (900, 901)}
    assert len(empty) == 1


def test_scores_do_not_depend_on_partitions_or_on_held_out_labels(spark, docs, prose):
    rows, labels = labelled(spark, prose, 80)
    other = [(d, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y, t) for d, y, t in labels]
    a = {r["doc_id"]: r["score"] for r in q.score(docs(rows, 1), spark.createDataFrame(labels, LABELS)).collect()}
    b = {r["doc_id"]: r["score"] for r in q.score(docs(rows, 5), spark.createDataFrame(other, LABELS)).collect()}
    assert a == b


def test_without_both_labels(spark, docs, prose):
    rows = [(k, prose(k, 5)) for k in range(6)]
    score = lambda labels: {r["score"] for r in q.score(docs(rows), spark.createDataFrame(labels, LABELS)).collect()}
    assert score([]) == {0.5} and score([(k, 1, 0) for k in range(6)]) == {1.0} and score([(k, 0, 0) for k in range(6)]) == {0.0}
    assert q.score(docs([]), spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0
