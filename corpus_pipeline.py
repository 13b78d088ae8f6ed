"""A corpus pipeline over ``documents``: language, exact copies, near copies, benchmark leaks, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; ``run`` writes every stage as Parquet into the shared folder and reads it
again for the next. The stages cannot be put in SQL (a learned model, seeded
hashes and a tokenizer), so ``ORACLE_SQL`` is None and the tests hold ``run``
against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cairn.llm import byte_bpe, decontaminate, exact_dedup, language_id, near_copies
from cairn.llm.common import shared_dir
from cairn.session import remove_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("encode", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``.

    A stage's table goes once the next one is written; that which the last stage reads stays.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_dir(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
