"""The dedup stages decide for each row, not for each doc_id."""

import pytest

from cairn.llm import exact_dedup, near_copies, simhash


def kept(stage, d):
    return sorted(((r["doc_id"], r["text"]) for r in stage(d).collect()), key=repr)


STAGES = [exact_dedup.keep_one, near_copies.keep_one, simhash.keep_one]


@pytest.mark.parametrize("stage", STAGES)
def test_one_row_of_each_class(docs, prose, stage):
    a, b, c, d, e = (prose(k, 30) for k in range(5))
    rows = [
        (1, a), (None, a), (None, b),  # a lost copy without an id, beside a text of its own
        (2, c), (3, c), (3, d),  # an id with two texts, one of them a copy
        (None, e), (None, e), (None, e + " "),  # a class without any id
        (7, prose(9, 30)), (7, prose(9, 30).replace(" ", "  ", 1)), (7, prose(9, 30).replace(" ", "\n", 1)),  # an id with copies
    ]
    got = kept(stage, docs(rows))
    assert [(i, " ".join(t.split())) for i, t in got] == sorted([(1, a), (None, b), (2, c), (3, d), (None, e), (7, prose(9, 30))], key=repr)


@pytest.mark.parametrize("stage", STAGES)
def test_repeated_rows_and_ids(docs, stage):
    rows = [(1, "aaa"), (1, "b"), (0, "b "), (7, "zz q"), (7, "zz q"), (8, "zz q"), (None, "n n"), (None, "n n"), (9, None), (9, None), (9, "")]
    assert [i for i, _ in kept(stage, docs(rows))] == [0, 1, 7, 9, None]
    twice = [(i, f"text number {i}") for i in range(5)] * 2
    assert [i for i, _ in kept(stage, docs(twice))] == [0, 1, 2, 3, 4]
