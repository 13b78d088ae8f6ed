"""Catalog views and shipping of whole databases."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.identifiers import quote
from cairn.schema import TableDef
from cairn.session import remove_dir

_REPLACED = "cairn.replaced"


def namespaces(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def tables(spark: SparkSession, namespace: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary]


def create_table(spark: SparkSession, table: TableDef, using: str = "parquet") -> None:
    spark.sql(table.ddl(using))


def overwrite_table(df: DataFrame, name: str, grace: float = 3600) -> None:
    """Write the rows to a folder of their own, then let the table point to it: readers see the old rows or the new ones, and
    those that have planned before go on with the old ones.

    A folder is removed by the first overwrite that comes ``grace`` seconds after it was replaced; until then the table's
    properties name it. New columns at the end are added to the table first; only where the columns change otherwise is the
    table made anew, and for a moment there is none.
    """
    spark = df.sparkSession
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.rpartition('.')[2]}__{uuid.uuid4().hex}"
    df.write.parquet(folder)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")
        return
    old = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    replaced = [*json.loads(told.get(_REPLACED, "[]")), [old, time.time()]]
    kept, now = [r for r in replaced if r[1] > time.time() - grace], {r[0] for r in replaced if r[1] <= time.time() - grace}
    known, wanted = ([(f.name, f.dataType.simpleString()) for f in x] for x in (spark.table(name).schema, df.schema))
    if wanted[: len(known)] == known:
        if new := wanted[len(known) :]:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{quote(c)} {kind}' for c, kind in new)})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_REPLACED}' = '{json.dumps(kept)}')")
    spark.catalog.refreshTable(name)
    for gone in now:
        remove_dir(spark, gone)


def partition_map(spark: SparkSession, name: str) -> DataFrame:
    """Partitions of a table."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def children(spark: SparkSession, name: str) -> DataFrame:
    """(value, child, location): the list partitions of a table, a row each, with the names that children have."""
    found = []
    for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
        if "/" in r[0]:
            raise ValueError(f"{name} is partitioned by more than one column")
        column, _, escaped = r[0].partition("=")
        value = None if escaped == "__HIVE_DEFAULT_PARTITION__" else unquote(escaped)
        spec = f"{quote(column)} = " + ("null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'")
        # the partition's own place is told before the table's
        place = next((row[1] for row in spark.sql(f"DESCRIBE FORMATTED {name} PARTITION ({spec})").collect() if row[0] == "Location"), None)
        found.append((value, f"{name.rpartition('.')[2]}_{value}", place))
    return spark.createDataFrame(sorted(found, key=str), "value string, child string, location string")


def export_database(spark: SparkSession, frames: dict[str, DataFrame], path: str, views: dict[str, str] | None = None, definitions: Sequence[TableDef] = ()) -> DataFrame:
    """Write tables as Parquet with a manifest of names, schemas, row counts, definitions and view texts."""
    known, rows = {d.name: d for d in definitions}, []
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/data/{name}")
        n = spark.read.parquet(f"{path}/data/{name}").count()
        rows.append(("table", name, df.schema.json(), n, known[name].to_json() if name in known else None))
    rows += [("view", name, None, None, text) for name, text in (views or {}).items()]
    manifest = spark.createDataFrame(rows, "kind string, name string, schema string, n_rows long, text string")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def import_database(spark: SparkSession, path: str, register: bool = True) -> dict[str, DataFrame]:
    """Read what ``export_database`` wrote; a table that lost rows is an error."""
    manifest = spark.read.schema("kind string, name string, schema string, n_rows long, text string").json(f"{path}/manifest").collect()
    found = {}
    for r in manifest:
        if r["kind"] == "table":
            df = spark.read.parquet(f"{path}/data/{r['name']}")
            if df.count() != r["n_rows"]:
                raise ValueError(f"table {r['name']} does not have {r['n_rows']} rows")
            found[r["name"]] = df
            if register:
                df.createOrReplaceTempView(quote(r["name"]))
    for r in manifest:
        if r["kind"] == "view" and register:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quote(r['name'])} AS {r['text']}")
    return found


def privileges(grants: DataFrame) -> DataFrame:
    """Roll up (object, grantee, privilege) rows: one row per object and grantee."""
    return grants.groupBy("object", "grantee").agg(F.array_join(F.array_sort(F.collect_set("privilege")), ",").alias("privileges"))
