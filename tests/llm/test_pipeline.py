import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from cairn.llm import language_id as li  # noqa: E402
from tests.llm import test_near_copies as near  # noqa: E402

A, B = ("ka", "lo", "mi", "ra"), ("stro", "weg", "thu", "pfen")


def test_run_against_brute_force(spark, docs, prose, tmp_path, monkeypatch):
    rows = [(i, prose(i, 40, A if i % 2 else B), "aa" if i % 2 else "bb") for i in range(60)]
    rows += [(100, rows[3][1] + "  ", "aa"), (101, rows[3][1], "aa"), (102, rows[4][1].upper(), "bb"), (103, None, "aa"), (104, "12 34", "aa"), (105, prose(77, 20, A) + " " + prose(500, 20, A), "aa"), (2, rows[2][1], "bb")]
    # near copies: one changed word of 120 leaves a similarity of 111 / 121, six of them 86 / 146
    base = prose(300, 120, A)
    rows += [(110, base, "aa"), (111, near.edited(base, [50]), "aa"), (112, near.edited(base, [3, 20, 40, 60, 80, 100]), "aa"), (113, near.edited(prose(301, 60, B), []), "bb")]
    # linked by way of another one only, and fingerprints far apart all the same
    rows += [(114, near.edited(base, [50, 90]), "aa"), (115, near.edited(base, [50, 90, 115]), "aa")]
    items = [(1, prose(77, 20, A))]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    # the language stage is learned; its decisions are fixed here, the others are worked out
    monkeypatch.setattr(li, "label_texts", lambda model, texts: (["aa" if li.has_letters(t) else "und" for t in texts], [1.0] * len(texts), [1.0] * len(texts)))
    model = li.Model([], None, None)
    monkeypatch.setattr(li, "learn", lambda d: model)

    stay = [(i, t) for i, t in dict.fromkeys((i, t) for i, t, _ in rows) if t and re.search("[a-z]", t.lower())]
    groups = {}
    for i, t in stay:
        groups.setdefault(re.sub(r"\s", "", t), []).append((-len(t), i))
    stay = [(i, t) for i, t in stay if min(groups[re.sub(r"\s", "", t)])[1] == i]
    kept = set(near.brute(stay))
    assert {111, 114} & kept == set() and {110, 112, 113} <= kept
    expected = sorted(i for i, t in stay if i in kept and items[0][1] not in t)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "encode"]
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in got.collect()) == expected


def test_stages_keep_the_columns(spark, docs, tmp_path):
    d = docs([(1, "some words", "aa")])
    spark.createDataFrame([(1, "other")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d, str(tmp_path)).columns == d.columns


def test_run_with_the_learned_language_stage(spark, docs, prose, tmp_path):
    rows = [(i, prose(i, 60, A if i % 2 else B), "aa" if i % 2 else "bb") for i in range(80)]
    noise = [(200, "", "aa"), (201, "1234 !!", "bb"), (202, None, None)]
    docs(rows + noise + [(300, rows[5][1], None)]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, prose(7, 60, A)[20:200])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted(set(near.brute([(i, t) for i, t, _ in rows])) - {7})
