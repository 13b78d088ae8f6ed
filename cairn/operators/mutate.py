"""Mutations of a keyed table.

A change log has the key columns, value columns, ``_seq`` (total order within a
key), ``_op`` ('put' or 'delete') and, for partial writes, ``_set`` (names of the
columns that a put sets). The result of applying a log is that of applying its
rows one by one in order.

Without conditions this needs no ordered fold: the last delete of a key divides
its log, and what remains is a first, a last, or a last per column, all of which
aggregate partially before the shuffle. Conditional and expression writes are not
commutative; their log is folded per key in order, in one expression, and where it is
longer than ``FOLD_ROWS`` in pieces, one after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import ranges
from cairn.session import remove_dir, work_dir

REPLACE, IGNORE, UPDATE = "replace", "ignore", "update"
#: Conflict policy where none is named.
DEFAULT_MODE = REPLACE
#: Changes of one key that are folded together.
FOLD_ROWS = 100_000
OPERATORS = {"greater": ">", "greater_equal": ">=", "less": "<", "less_equal": "<=", "equal": "=", "not_equal": "<>", "is_null": "IS NULL", "is_not_null": "IS NOT NULL"}


def _on(a: DataFrame, b: DataFrame, key: Sequence[str]) -> list[Column]:
    return [a[k].eqNullSafe(b[k]) for k in key]


def _is_set(changes: DataFrame, name: str) -> Column:
    return F.array_contains("_set", name) if "_set" in changes.columns else F.lit(True)


def _ready(changes: DataFrame) -> DataFrame:
    return changes if "_op" in changes.columns else changes.withColumn("_op", F.lit("put"))


def keep_last(rows: DataFrame, key: Sequence[str], order: str = "_seq") -> DataFrame:
    """The last row of each key."""
    rest = [c for c in rows.columns if c not in key]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return last.select(*key, *[F.col("_row")[c].alias(c) for c in rest]).select(*rows.columns)


def merge_changes(changes: DataFrame, key: Sequence[str], values: Sequence[str], mode: str, insert_only: Sequence[str] = ()) -> DataFrame:
    """One row per key: what a log amounts to.

    ``_deleted``: it deletes the row; ``_put``: a put comes after the last delete.
    For each column the value and whether it is set.
    """
    changes = _ready(changes)
    deletes = changes.where("_op = 'delete'").groupBy(*key).agg(F.max("_seq").alias("_del"))
    after = changes.where("_op = 'put'")
    d = deletes.select(*[F.col(k).alias(f"_d_{k}") for k in key], "_del")
    puts = after.join(d, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in key], "left").where("_del IS NULL OR _seq > _del")
    cells = lambda: F.struct(*[F.struct(F.when(_is_set(changes, v), F.col(v)).alias("value"), _is_set(changes, v).alias("is_set")).alias(v) for v in values])
    if mode == UPDATE:
        first = F.min_by(cells(), "_seq")
        folded = puts.groupBy(*key).agg(
            first.alias("_first"),
            *[F.max_by(F.struct(F.col(v).alias("value"), F.lit(True).alias("is_set")), F.when(_is_set(changes, v), F.col("_seq"))).alias(f"_c_{v}") for v in values],
        ).select(*key, F.lit(True).alias("_put"), *[(F.col("_first")[v] if v in insert_only else F.col(f"_c_{v}")).alias(v) for v in values])
    else:
        pick = F.min_by if mode == IGNORE else F.max_by
        folded = puts.groupBy(*key).agg(pick(cells(), "_seq").alias("_row")).select(*key, F.lit(True).alias("_put"), *[F.col("_row")[v].alias(v) for v in values])
    both = folded.join(d, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in key], "full_outer")
    return both.select(
        *[F.when(F.col("_put").isNull(), F.col(f"_d_{k}")).otherwise(F.col(k)).alias(k) for k in key],
        F.col("_del").isNotNull().alias("_deleted"), F.coalesce("_put", F.lit(False)).alias("_put"), *values)


def apply_mutations(
    base: DataFrame, changes: DataFrame, key: Sequence[str], mode: str = DEFAULT_MODE,
    insert_only: Sequence[str] = (), ignore_null: bool = False, defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """The table after a log of puts and deletes. Without a key nothing merges: puts are appended.

    ``insert_only`` columns are written on insert alone, ``ignore_null`` treats a null
    as not set, ``defaults`` fill columns that an insert does not set.
    """
    if mode not in (REPLACE, IGNORE, UPDATE):
        raise ValueError(f"no such mode: {mode}")
    changes = _ready(changes)
    values = [c for c in base.columns if c not in key]
    for v in values:
        if v not in changes.columns:
            changes = changes.withColumn(v, F.lit(None).cast(base.schema[v].dataType))
            if "_set" not in changes.columns:
                changes = changes.withColumn("_set", F.array(*[F.lit(c) for c in base.columns if c in changes.columns and c != v]))
    if not key:
        return base.unionByName(changes.where("_op = 'put'").select(*base.columns))
    if ignore_null:
        names = F.col("_set") if "_set" in changes.columns else F.array(*map(F.lit, values))
        is_null = F.array_compact(F.array(*[F.when(F.col(v).isNull(), F.lit(v)) for v in values]))
        changes = changes.withColumn("_set", F.array_except(names, is_null))
    log = merge_changes(changes, key, values, mode, insert_only)
    b = base.select(*[F.col(k).alias(f"_b_{k}") for k in key], *[F.col(v).alias(f"_b_{v}") for v in values], F.lit(True).alias("_base"))
    both = b.join(log, [F.col(f"_b_{k}").eqNullSafe(F.col(k)) for k in key], "full_outer")
    alive = F.coalesce("_base", F.lit(False)) & ~F.coalesce("_deleted", F.lit(False))
    put = F.coalesce("_put", F.lit(False))
    out = []
    for v in values:
        old, new, is_set = F.col(f"_b_{v}"), F.col(v)["value"], F.coalesce(F.col(v)["is_set"], F.lit(False))
        fresh = F.when(is_set, new).otherwise((defaults or {}).get(v, F.lit(None)))
        if mode == REPLACE:
            value = F.when(put, fresh).otherwise(old)
        elif mode == IGNORE:
            value = F.when(alive, old).otherwise(fresh)
        else:
            value = F.when(alive, old if v in insert_only else F.when(put & is_set, new).otherwise(old)).otherwise(fresh)
        out.append(value.cast(base.schema[v].dataType).alias(v))
    keys = [F.when(F.col("_base"), F.col(f"_b_{k}")).otherwise(F.col(k)).cast(base.schema[k].dataType).alias(k) for k in key]
    return both.where(alive | put).select(*keys, *out).select(*base.columns)


def delete_keys(base: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """The table without the rows of the given keys."""
    if not key:
        raise ValueError("a delete needs a key")
    return base.join(keys, _on(base, keys, key), "left_anti")


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def expression_upsert(
    base: DataFrame, changes: DataFrame, key: Sequence[str], set_: dict[str, str] | None = None, where: str | None = None,
) -> DataFrame:
    """Ordered puts and deletes with SQL text over ``old`` and ``excluded``.

    On an existing row a put makes the assignments of ``set_`` (default: every column
    from the put) if ``where`` holds; on an absent one it inserts. A delete removes the
    row if ``where`` holds; it takes no assignments. Repeated keys are applied in order.
    """
    if not key:
        raise ValueError("expression writes need a key")
    if set_ and (missing := [c for c in set_ if c not in base.columns or c in key]):
        raise ValueError(f"not assignable: {missing}")
    changes = _ready(changes)
    values = [c for c in base.columns if c not in key]
    if missing := [k for k in key if k not in changes.columns]:
        raise ValueError(f"key columns without a value: {missing}")
    if unset := [v for v in values if v not in changes.columns]:
        if needed := [v for v in unset if set_ and v in set_ and "excluded." in set_[v]]:
            raise ValueError(f"assigned from the put, which does not set them: {needed}")
        changes = changes.withColumns({v: F.lit(None).cast(base.schema[v].dataType) for v in unset})
        set_ = set_ if set_ is not None else {v: f"excluded.{_tick(v)}" for v in values if v not in unset}
    kind = {v: base.schema[v].dataType.simpleString() for v in values}
    assign = set_ if set_ is not None else {v: f"excluded.{_tick(v)}" for v in values}
    holds = f"coalesce({where}, false)" if where else "true"
    row = lambda cells: "named_struct('_exists', true, " + ", ".join(f"'{v}', CAST({c} AS {kind[v]})" for v, c in cells.items()) + ")"
    gone = "named_struct('_exists', false, " + ", ".join(f"'{v}', CAST(NULL AS {kind[v]})" for v in values) + ")"
    start = "named_struct('_exists', _base, " + ", ".join(f"'{v}', CAST(_b.{_tick(v)} AS {kind[v]})" for v in values) + ")"
    step = (
        f"CASE WHEN excluded._op = 'delete' THEN CASE WHEN old._exists AND {holds} THEN {gone} ELSE old END"
        f" WHEN NOT old._exists THEN {row({v: f'excluded.{_tick(v)}' for v in values})}"
        f" WHEN {holds} THEN {row({v: assign.get(v, f'old.{_tick(v)}') for v in values})} ELSE old END")
    fold = lambda held, log: _folded(held, log, key, values, start, step)
    long = changes.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > FOLD_ROWS)
    return fold(base, changes) if long.isEmpty() else _folded_in_pieces(base, changes, key, long, fold)


def _folded(base: DataFrame, changes: DataFrame, key: Sequence[str], values: Sequence[str], start: str, step: str) -> DataFrame:
    """Fold each key's changes into its row, in order, in one expression."""
    log = changes.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(F.array_sort(F.collect_list(F.struct("_seq", "_op", *key, *values))).alias("_log"))
    held = base.select(*key, F.struct(*values).alias("_b"), F.lit(True).alias("_base"))
    both = held.join(log, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key], "full_outer").withColumn("_base", F.coalesce("_base", F.lit(False)))
    folded = both.withColumn("_end", F.expr(f"aggregate(coalesce(_log, array()), {start}, (old, excluded) -> {step})"))
    keys = [F.when(F.col("_base"), F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in key]
    return folded.where("_end._exists").select(*keys, *[F.col("_end")[v].alias(v) for v in values]).select(*base.columns)


def _folded_in_pieces(base: DataFrame, changes: DataFrame, key: Sequence[str], long: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Keys with long logs apart: their changes are numbered in order over range partitions and stored in pieces of
    ``FOLD_ROWS`` a key, and one piece after the other is folded into their rows, so no task holds more of a key at once."""
    spark, folder = base.sparkSession, work_dir(base.sparkSession, "fold")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    hot = kept(long.select(*[F.col(k).alias(f"_hot_{k}") for k in key], "_n"), "keys")
    match = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in key]
    numbered = ranges.numbered(changes.join(hot, match, "left_semi"), "_at", key, ["_seq"])
    numbered.withColumn("_piece", F.floor((F.col("_at") - 1) / FOLD_ROWS).cast("int")).drop("_at").write.partitionBy("_piece").parquet(f"{folder}/log")
    state = kept(base.join(hot, match, "left_semi"), "rows-0")
    for piece in range(-(-hot.agg(F.max("_n")).first()[0] // FOLD_ROWS)):
        log = spark.read.schema(changes.schema).parquet(f"{folder}/log/_piece={piece}")
        state = kept(fold(state, log), f"rows-{piece + 1}")
        remove_dir(spark, f"{folder}/rows-{piece}")
    return fold(base.join(hot, match, "left_anti"), changes.join(hot, match, "left_anti")).unionByName(state)


_STRICT = {"greater": F.max_by, "less": F.min_by}


def _put_extremes(base: DataFrame, changes: DataFrame, key: Sequence[str], column: str, operator: str, null_as: str | None) -> DataFrame:
    """Puts alone that need a greater (or smaller) value in one column: of a key's log only two rows matter, the first,
    which inserts where there is no row, and the first with the extreme value. Both aggregate partially, so the log of a hot key is never gathered."""
    values = [c for c in base.columns if c not in key]
    row = F.struct(*[F.col(v).cast(base.schema[v].dataType).alias(v) for v in values])
    place = F.struct(F.col(column), -F.col("_seq") if operator == "greater" else F.col("_seq"))
    log = changes.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(
        F.min_by(row, "_seq").alias("_first"), _STRICT[operator](row, F.when(F.col(column).isNotNull(), place)).alias("_best"))
    held = base.select(*key, F.struct(*values).alias("_b"), F.lit(True).alias("_base"))
    both = held.join(log, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key], "full_outer")
    start = F.when(F.col("_base"), F.col("_b")).otherwise(F.col("_first"))
    old = f"coalesce(_start.{_tick(column)}, {null_as})" if null_as is not None else f"_start.{_tick(column)}"
    end = F.when(F.expr(f"_best.{_tick(column)} {OPERATORS[operator]} {old}"), F.col("_best")).otherwise(F.col("_start"))
    keys = [F.when(F.col("_base"), F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in key]
    return both.withColumn("_start", start).withColumn("_end", end).select(*keys, *[F.col("_end")[v].alias(v) for v in values]).select(*base.columns)


def checked_log(changes: DataFrame, key: Sequence[str], column: str, operator: str, value: str | None = None, partition: str | None = None) -> DataFrame:
    """The changes of a conditional write, of which any that cannot be made ends the job: a null in the key or in the
    partition column, and a delete whose own value is compared and is null."""
    stop = lambda text: F.raise_error(F.lit(text)).cast("boolean")
    fine = F.lit(True)
    for k in dict.fromkeys([*key, *([partition] if partition else [])]):
        fine = F.when(F.col(k).isNull(), stop(f"{k} is null in a conditional write")).otherwise(fine)
    if "_op" in changes.columns and value is None and operator not in ("is_null", "is_not_null"):
        fine = F.when((F.col("_op") == "delete") & F.col(column).isNull(), stop(f"{column} is null in a conditional delete")).otherwise(fine)
    return changes.where(fine)


def check_and_put(
    base: DataFrame, changes: DataFrame, key: Sequence[str], column: str, operator: str, value: str | None = None, null_as: str | None = None,
) -> DataFrame:
    """Puts and deletes that apply to an existing row only if ``new OP coalesce(old, null_as)``.

    ``value`` (SQL text) stands for the new value where it is a constant; IS [NOT] NULL
    test the old one; a comparison that is unknown changes nothing; a put without an
    existing row inserts.
    """
    if not key:
        raise ValueError("conditional writes need a key")
    if operator not in OPERATORS:
        raise ValueError(f"no such operator: {operator}")
    if column not in base.columns:
        raise ValueError(f"no such column: {column}")
    if value is None and operator not in ("is_null", "is_not_null") and column not in changes.columns:
        raise ValueError(f"the checked column {column} is not set")
    if missing := [c for c in base.columns if c not in changes.columns and c not in key]:
        changes = changes.withColumns({c: F.lit(None).cast(base.schema[c].dataType) for c in missing})
    old = f"old.{_tick(column)}"
    if operator in ("is_null", "is_not_null"):
        return expression_upsert(base, changes, key, where=f"{old} {OPERATORS[operator]}")
    held = f"coalesce({old}, {null_as})" if null_as is not None else old
    if value is None and operator in _STRICT and "_op" not in changes.columns:
        return _put_extremes(base, changes, key, column, operator, null_as)
    return expression_upsert(base, changes, key, where=f"{value if value is not None else f'excluded.{_tick(column)}'} {OPERATORS[operator]} {held}")
