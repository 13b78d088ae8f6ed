"""Decoding of message-queue records into table rows.

Works on frames with the columns of Spark's Kafka source: key, value, topic,
partition, offset, timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("json", "struct_json", "string")
META = {"topic": "topic", "partition": "partition", "offset": "offset", "timestamp": "timestamp"}


def decode(records: DataFrame, schema: T.StructType, form: str = "json", meta: dict[str, str] | None = None, start: Column | None = None, columns: tuple[str, str] = ("key", "value")) -> DataFrame:
    """Rows and ``_bad``, true where a payload does not parse.

    ``json``: an object with the table's columns. ``struct_json``: an object with
    ``schema`` and ``payload``. ``string``: key and value as two text columns. ``meta``
    maps topic, partition, offset or timestamp to column names; records before ``start``
    are skipped.
    """
    if form not in FORMATS:
        raise ValueError(f"no such format: {form}")
    if bad := set(meta or {}) - set(META):
        raise ValueError(f"no such record fields: {sorted(bad)}")
    if start is not None:
        records = records.where(F.col("timestamp") >= start)
    extra = [F.col(META[m]).alias(name) for m, name in (meta or {}).items()]
    value = F.col("value").cast("string")
    if form == "string":
        return records.select(F.col("key").cast("string").alias(columns[0]), value.alias(columns[1]), *extra, F.lit(False).alias("_bad"))
    shape = schema if form == "json" else T.StructType([T.StructField("payload", schema)])
    with_bad = T.StructType([*shape.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(value, with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    row = parsed if form == "json" else parsed["payload"]
    return records.withColumn("_row", row).withColumn("_wrong", parsed["_corrupt"].isNotNull() | value.isNull() | row.isNull()).select(
        *[F.col("_row")[f.name].alias(f.name) for f in schema], *extra, F.col("_wrong").alias("_bad"))
