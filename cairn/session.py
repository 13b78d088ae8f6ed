"""Session settings and table loading."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(app: str = "cairn", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the engine expects.

    Cluster settings (executors, memory, shuffle partitions) belong to the
    submitter; only what affects results or re-planning is fixed here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, register: bool = False) -> dict[str, DataFrame]:
    """All tables of a data directory; optionally as temporary views for ``spark.sql``."""
    found = {name: table(spark, sf_dir, name) for name in TABLES}
    if register:
        for name, df in found.items():
            df.createOrReplaceTempView(name)
    return found


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session that names none (tests on one machine) gets a temporary one; on
    a cluster that would be another folder on every machine, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="cairn-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of a store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
