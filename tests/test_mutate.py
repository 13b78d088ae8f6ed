import random

import pytest

from cairn.operators import mutate
from tests import interpreter

BASE = "k long, a long, b string"
LOG = "k long, _seq long, _op string, a long, b string, _set array<string>"


def make(seed, deletes=True, partial=True):
    rng = random.Random(seed)
    base = {k: {"a": rng.choice([None, 1, 2, 3]), "b": rng.choice([None, "x", "y"])} for k in [None, *range(8)] if rng.random() < 0.7}
    log = []
    for _ in range(rng.randint(0, 60)):
        key = rng.choice([None, *range(12)])
        if deletes and rng.random() < 0.25:
            log.append((key, "delete", {}))
        else:
            cells = {"a": rng.choice([None, *range(10)]), "b": rng.choice([None, "p", "q"])}
            log.append((key, "put", {n: v for n, v in cells.items() if not partial or rng.random() < 0.6}))
    return base, log


def frames(spark, base, log, sets=True):
    b = spark.createDataFrame([(k, r["a"], r["b"]) for k, r in base.items()], BASE)
    c = spark.createDataFrame([(k, i, op, cells.get("a"), cells.get("b"), list(cells)) for i, (k, op, cells) in enumerate(log)], LOG)
    return b, c if sets else c.drop("_set")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def expected(table):
    return sorted(((k, r["a"], r["b"]) for k, r in table.items()), key=str)


@pytest.mark.parametrize("mode", [mutate.REPLACE, mutate.IGNORE, mutate.UPDATE])
@pytest.mark.parametrize("seed", range(4))
def test_log_is_applied_in_order(spark, mode, seed):
    base, log = make(seed)
    assert rows(mutate.apply_mutations(*frames(spark, base, log), ["k"], mode)) == expected(interpreter.apply(base, log, mode))


@pytest.mark.parametrize("seed", range(4, 7))
def test_insert_only(spark, seed):
    base, log = make(seed)
    assert rows(mutate.apply_mutations(*frames(spark, base, log), ["k"], "update", insert_only=["a"])) == expected(interpreter.apply(base, log, "update", ["a"]))


def test_ignore_null(spark):
    base, log = make(9, deletes=False, partial=False)
    kept = [(k, op, {n: v for n, v in c.items() if v is not None}) for k, op, c in log]
    assert rows(mutate.apply_mutations(*frames(spark, base, log, False), ["k"], "update", ignore_null=True)) == expected(interpreter.apply(base, kept, "update"))


OPS = {"greater": lambda a, b: a > b, "less_equal": lambda a, b: a <= b, "equal": lambda a, b: a == b, "not_equal": lambda a, b: a != b}


@pytest.mark.parametrize("name", OPS)
@pytest.mark.parametrize("null_as", [None, 5])
def test_conditional(spark, name, null_as):
    def compare(new, old):
        return new is not None and old is not None and OPS[name](new, old)

    base, log = make(hash(name) % 100, partial=False)
    log = [(k, op, c or {"a": 4, "b": None}) for k, op, c in log]
    got = mutate.check_and_put(*frames(spark, base, log, False), ["k"], "a", name, null_as=None if null_as is None else str(null_as))
    assert rows(got) == expected(interpreter.conditional(base, log, "a", compare, null_as))


@pytest.mark.parametrize("name, test", [("is_null", lambda old: old is None), ("is_not_null", lambda old: old is not None)])
def test_conditional_on_null(spark, name, test):
    base, log = make(21, deletes=False, partial=False)
    got = mutate.check_and_put(*frames(spark, base, log, False), ["k"], "a", name)
    assert rows(got) == expected(interpreter.conditional(base, log, "a", lambda new, old: test(old)))


def test_constant_condition(spark):
    base, log = {1: {"a": 5, "b": "x"}, 2: {"a": 50, "b": "x"}}, [(1, "put", {"a": 1, "b": "n"}), (2, "put", {"a": 1, "b": "n"})]
    assert rows(mutate.check_and_put(*frames(spark, base, log, False), ["k"], "a", "greater", value="10")) == [(1, 1, "n"), (2, 50, "x")]


def test_expression(spark):
    base, log = {1: {"a": 5, "b": "x"}}, [(1, "put", {"a": 2, "b": "y"}), (1, "put", {"a": 1, "b": "z"}), (2, "put", {"a": 3, "b": "n"}), (2, "delete", {"a": 1, "b": None})]
    got = mutate.expression_upsert(*frames(spark, base, log, False), ["k"], {"a": "old.a + excluded.a"}, "excluded.a > 1 OR excluded._op = 'delete'")
    assert rows(got) == [(1, 7, "x")]


def test_keyless_tables_append(spark):
    base, log = {1: {"a": 1, "b": "x"}}, [(1, "put", {"a": 2, "b": "y"})]
    b, c = frames(spark, base, log, False)
    assert rows(mutate.apply_mutations(b, c, [], "replace")) == [(1, 1, "x"), (1, 2, "y")]
    with pytest.raises(ValueError):
        mutate.delete_keys(b, c, [])


def test_defaults_and_validation(spark):
    from pyspark.sql import functions as F

    b, c = frames(spark, {}, [(1, "put", {"b": "y"})])
    assert rows(mutate.apply_mutations(b, c, ["k"], "update", defaults={"a": F.lit(42)})) == [(1, 42, "y")]
    for bad in (lambda: mutate.apply_mutations(b, c, ["k"], "merge"), lambda: mutate.check_and_put(b, c, ["k"], "zz", "greater"), lambda: mutate.check_and_put(b, c, ["k"], "a", "like"),
                lambda: mutate.expression_upsert(b, c, ["k"], {"k": "1"}), lambda: mutate.expression_upsert(b, c, [])):
        with pytest.raises(ValueError):
            bad()


def test_missing_columns_keep_old_values_on_update(spark):
    b, c = frames(spark, {1: {"a": 5, "b": "x"}}, [(1, "put", {"a": 6})], False)
    assert rows(mutate.apply_mutations(b, c.drop("b"), ["k"], "update")) == [(1, 6, "x")]


def test_long_logs_are_folded_in_pieces(spark, monkeypatch):
    import random

    rng = random.Random(8)
    base = spark.createDataFrame([(k, k * 10, "b") for k in range(6)] + [(None, 7, "n")], "k int, v long, s string")
    log = [(rng.choice([0, 0, 0, 1, 2, 9, None, None]), seq, rng.choice(["put", "put", "put", "delete"]), rng.randint(0, 50), f"s{seq}") for seq in range(300)]
    changes = spark.createDataFrame(log, "k int, _seq long, _op string, v long, s string").repartition(5)
    fold = lambda: sorted((tuple(r) for r in mutate.expression_upsert(base, changes, ["k"], {"v": "old.v * 3 % 1000 + excluded.v", "s": "excluded.s"}, "excluded.v % 7 <> old.v % 7").collect()), key=str)
    whole = fold()
    for most in (100, 17, 1):
        monkeypatch.setattr(mutate, "FOLD_ROWS", most)
        if most > 1:
            assert fold() == whole
    monkeypatch.setattr(mutate, "FOLD_ROWS", 40)
    checked = lambda: sorted((tuple(r) for r in mutate.check_and_put(base, changes, ["k"], "v", "greater_equal").collect()), key=str)
    pieces = checked()
    monkeypatch.setattr(mutate, "FOLD_ROWS", 1000)
    assert checked() == pieces
