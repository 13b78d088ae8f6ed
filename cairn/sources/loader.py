"""Loading of foreign rows into a table: mapping, cleaning, statements before and after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions import convert
from cairn.schema import TableDef, spark_type
from cairn.sources.keyed_table import KeyedTable


#: What happens to rows with a value that does not parse: it becomes null, the load fails, or the row is left out.
NULL, EXCEPTION, SKIP = "null", "exception", "skip"


def map_columns(df: DataFrame, table: TableDef, names: Sequence[str] | None = None, empty_as_null: bool = True, array_delimiter: str = ",", problems: bool = False) -> DataFrame:
    """Source columns, by position, under the table's names and types; with ``problems`` also ``_problems``, the names of columns whose value does not parse."""
    names = list(names or [c.name for c in table.columns])
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} source columns for {len(names)} target columns")
    kinds = {c.name: c.type for c in table.columns}
    if missing := [n for n in names if n not in kinds]:
        raise ValueError(f"no such columns: {missing}")
    out, found = [], []
    for source, name in zip(df.columns, names, strict=True):
        value, target = F.col(f"`{source}`"), spark_type(kinds[name])
        if isinstance(df.schema[source].dataType, T.StringType):
            value = convert.remove_nul(value)
            if empty_as_null:
                value = convert.empty_as_null(value)
        given = value.isNotNull()
        if isinstance(df.schema[source].dataType, T.StringType):
            if isinstance(target, T.ArrayType):
                value = convert.split_array(value, array_delimiter, kinds[name].removesuffix("[]"))
                found.append(F.when(F.exists(value, lambda x: x.isNull()), F.lit(name)))
            elif isinstance(target, (T.TimestampType, T.TimestampNTZType)):
                value = convert.parse_timestamp(value)
        mapped = value.try_cast(target)
        if not isinstance(target, T.ArrayType):
            found.append(F.when(given & mapped.isNull(), F.lit(name)))
        out.append(mapped.alias(name))
    return df.select(*out, *([F.array_compact(F.array(*found)).alias("_problems")] if problems else []))


def load(
    df: DataFrame, target: KeyedTable, table: TableDef, before: Sequence[str] = (), after: Sequence[str] = (), order: str | None = None,
    mode: str = "replace", dirty: str = NULL, **how,
) -> DataFrame:
    """Run statements, merge the mapped rows, run statements; of rows with the same key the last by ``order`` stays.

    Returns the rows with values that do not parse, with ``_problems``; ``dirty`` says what becomes of them.
    """
    if dirty not in (NULL, EXCEPTION, SKIP):
        raise ValueError(f"no such policy: {dirty}")
    spark = df.sparkSession
    for text in before:
        spark.sql(text)
    rows = map_columns(df, table, problems=True, **how)
    bad = rows.where(F.size("_problems") > 0)
    if dirty == EXCEPTION:
        stop = F.raise_error(F.concat(F.lit("dirty row: "), F.array_join("_problems", ", "))).cast("boolean")
        rows = rows.where(F.when(F.size("_problems") > 0, stop).otherwise(F.lit(True)))
    elif dirty == SKIP:
        rows = rows.where(F.size("_problems") == 0)
    target.merge(rows.drop("_problems").withColumn("_seq", F.col(order) if order else F.monotonically_increasing_id()), mode=mode)
    for text in after:
        spark.sql(text)
    return bad
