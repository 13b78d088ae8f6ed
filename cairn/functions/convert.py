"""Value conversions on write, and the split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.schema import TableDef, spark_type

ZERO_DATE = "0000-00-00 00:00:00"


def remove_nul(value: Column, is_array: bool = False) -> Column:
    """Text, or each text of an array, without U+0000."""
    return F.transform(value, lambda v: F.replace(v, F.lit("\x00"), F.lit(""))) if is_array else F.replace(value, F.lit("\x00"), F.lit(""))


def from_epoch_ms(value: Column, target: str) -> Column:
    """Milliseconds since the epoch, as a number or numeric text, to timestamptz, timestamp, date or time."""
    stamp = F.timestamp_millis(value.try_cast("long"))
    if target == "timestamptz":
        return stamp
    if target == "timestamp":
        return stamp.cast("timestamp_ntz")
    if target == "date":
        return F.to_date(stamp)
    if target == "time":
        return F.date_format(stamp, "HH:mm:ss.SSS")
    raise ValueError(f"no such target: {target}")


def parse_timestamp(text: Column, numeric_is_ms: bool = False) -> Column:
    """Flexible timestamps: a date, or date and time with ' ' or 'T', a fraction, and an offset or Z.

    The zero date is the epoch; text that is no timestamp gives null; with
    ``numeric_is_ms`` digits alone are milliseconds.
    """
    trimmed = F.trim(text)
    spaced = F.regexp_replace(trimmed, r"^(\d{4}-\d{2}-\d{2})[ T]+", "$1 ")
    zoned = F.regexp_replace(spaced, r"([+-]\d{2})$", "$1:00")
    shaped = F.when(spaced.rlike(r"^\d{4}-\d{2}-\d{2}( \d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?([+-]\d{2}(:?\d{2})?|Z)?)?$"), F.when(spaced.rlike(r":\d{2}.*[+-]\d{2}$"), zoned).otherwise(spaced))
    found = F.when(trimmed == ZERO_DATE, F.timestamp_millis(F.lit(0))).otherwise(shaped.try_cast("timestamp"))
    return F.when(trimmed.rlike(r"^-?\d+$"), F.timestamp_millis(trimmed.try_cast("long"))).otherwise(found) if numeric_is_ms else found


def offset_micros(text: Column) -> Column:
    """Start time of a subscription, ISO or SQL style, to microseconds; the session's zone where none is given."""
    return F.unix_micros(parse_timestamp(text))


def default_literal(kind: str, declared: str | None) -> Column:
    """What fills a null in a column that must not be null: the declared default, else the type's zero."""
    target = spark_type(kind)
    if declared is not None:
        plain = declared.split("::")[0].strip()
        if plain.lower() in ("now()", "current_timestamp"):
            return F.current_timestamp().cast(target)
        return F.lit(plain[1:-1].replace("''", "'") if plain.startswith("'") and plain.endswith("'") else plain).cast(target)
    if isinstance(target, T.NumericType):
        return F.lit(0).cast(target)
    if isinstance(target, T.BooleanType):
        return F.lit(False)
    if isinstance(target, T.StringType):
        return F.lit("")
    if isinstance(target, T.BinaryType):
        return F.lit("").cast("binary")
    if isinstance(target, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(target)
    if isinstance(target, T.ArrayType):
        return F.array().cast(target)
    raise ValueError(f"no default for {kind}")


def fill_defaults(df: DataFrame, table: TableDef) -> DataFrame:
    """Fill nulls of columns that must not be null; serial and generated columns are left alone."""
    filled = {c.name: F.coalesce(F.col(c.name), default_literal(c.type, c.default)) for c in table.columns
              if not c.nullable and not c.is_serial and not c.generated and c.name in df.columns}
    return df.withColumns(filled)


def fit_length(value: Column, kind: str, n: int) -> Column:
    """``char`` pads to n and cuts, ``varchar`` only cuts."""
    return F.rpad(value, n, " ") if kind == "char" else F.substring(value, 1, n)


def split_array(text: Column, delimiter: str, kind: str = "text") -> Column:
    """Array from delimited text; empty text is null."""
    parts = F.split(text, "\\Q" + delimiter + "\\E")
    return F.when((text == "") | text.isNull(), F.lit(None)).otherwise(F.transform(parts, lambda p: p.try_cast(spark_type(kind))))


def empty_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def compact(value: Column) -> Column:
    """Array without its null elements."""
    return F.array_compact(value)


def normalise_json(text: Column) -> Column:
    """JSON text in one form: sorted keys, no spaces; null where it is not JSON."""
    return F.to_json(F.try_parse_json(text))


def problems(df: DataFrame, table: TableDef) -> Column:
    """Array of the reasons why a row cannot be written, empty for a good one."""
    found: list[Column] = []
    for c in table.columns:
        if c.name not in df.columns:
            if not c.nullable and c.default is None and not c.is_serial and not c.generated:
                found.append(F.lit(f"{c.name}: missing"))
            continue
        value, target = F.col(c.name), spark_type(c.type)
        if not c.nullable:
            found.append(F.when(value.isNull(), F.lit(f"{c.name}: null")))
        if df.schema[c.name].dataType != target:
            found.append(F.when(value.isNotNull() & value.try_cast(target).isNull(), F.lit(f"{c.name}: not a {c.type}")))
        if c.length and isinstance(target, T.StringType):
            found.append(F.when(F.char_length(value.cast("string")) > c.length, F.lit(f"{c.name}: longer than {c.length}")))
        if isinstance(target, T.ArrayType) and isinstance(df.schema[c.name].dataType, T.ArrayType):
            found.append(F.when(F.exists(value, lambda x: x.isNull()), F.lit(f"{c.name}: null element")))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def split_dirty(df: DataFrame, table: TableDef, policy: str = "exception", extra: Sequence[str] = (), once: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows cast to the table's types, rejected rows with ``_problems``).

    Policy ``exception`` ends the job at the first bad row, ``skip`` drops bad rows from
    the good ones, which the second frame still reports. ``skip_once`` drops the bad rows
    that ``once`` names, as by their place in the source, and any other bad row ends the job.
    """
    if policy not in ("exception", "skip", "skip_once"):
        raise ValueError(f"no such policy: {policy}")
    if (policy == "skip_once") != (once is not None):
        raise ValueError("skip_once needs to be told which rows, other policies do not")
    judged = df.withColumn("_problems", problems(df, table))
    bad = judged.where(F.size("_problems") > 0)
    cast = [F.col(c.name).try_cast(spark_type(c.type)).alias(c.name) for c in table.columns if c.name in df.columns] + [F.col(e) for e in extra]
    if policy != "skip":
        if once is not None:
            judged = judged.where(~(F.coalesce(once, F.lit(False)) & (F.size("_problems") > 0)))
        stop = F.when(F.size("_problems") > 0, F.raise_error(F.concat(F.lit("dirty row: "), F.array_join("_problems", "; "))).cast("boolean")).otherwise(F.lit(True))
        return judged.where(stop).select(cast), bad
    return judged.where(F.size("_problems") == 0).select(cast), bad
