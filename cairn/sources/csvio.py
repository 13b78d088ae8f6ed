"""Bulk export to and import from CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.sharding import with_shard

NULL = "N"


def export_csv(df: DataFrame, path: str, delimiter: str = ",", null: str = NULL, header: bool = False, key: Sequence[str] = (), shards: int = 0, only: tuple[int, int] | None = None) -> None:
    """Write CSV; with ``only`` = (first, end) the rows of those of ``shards`` shards."""
    if only:
        df = with_shard(df, key, shards).where((F.col("_shard") >= only[0]) & (F.col("_shard") < only[1])).drop("_shard")
    texts = [F.col(f.name).cast("string").alias(f.name) if not isinstance(f.dataType, (T.BinaryType, T.ArrayType)) else F.to_json(F.struct(f.name)).alias(f.name) for f in df.schema]
    df.select(texts).write.mode("overwrite").csv(path, sep=delimiter, nullValue=null, quote='"', escape='"', header=header, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def import_csv(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", null: str = NULL, header: bool = False, multiline: bool = True) -> DataFrame:
    """Read what ``export_csv`` wrote, with the types of a table."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.csv(path, schema=as_text, sep=delimiter, nullValue=null, quote='"', escape='"', header=header, multiLine=multiline, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, mode="FAILFAST")
    nested = lambda f: isinstance(f.dataType, (T.BinaryType, T.ArrayType))
    return raw.select([
        (F.from_json(F.col(f.name), T.StructType([f]))[f.name] if nested(f) else F.col(f.name).cast(f.dataType)).alias(f.name) for f in schema])
