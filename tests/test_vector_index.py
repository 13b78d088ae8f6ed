import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import retrieval, vector_index
from cairn.operators.vector_index import VectorIndex


def clustered(spark, n=600, dims=8, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 5, (12, dims))
    # a third of the rows in one place
    x = middles[np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, 12, n))] + rng.normal(0, 1, (n, dims))
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"]) for r in df.collect())


@pytest.mark.parametrize("metric", ["l2", "cosine", "inner"])
def test_probing_every_list_is_exact(spark, tmp_path, monkeypatch, metric):
    monkeypatch.setattr(vector_index, "PART_ROWS", 50)
    monkeypatch.setattr(vector_index, "BLOCK_QUERIES", 7)
    rows = clustered(spark)
    index = VectorIndex.build(rows, str(tmp_path / "i"), metric=metric, lists=9)
    asked = rows.where("vec_id % 20 = 3")
    exact = retrieval.nearest_for(asked, rows, 4, metric=metric)
    assert found(index.search(asked, 4, 9)) == found(exact)


def test_recall_and_lists_read(spark, tmp_path):
    rows = clustered(spark)
    index = VectorIndex.build(rows, str(tmp_path / "i"))
    told, asked = index.described(), rows.where("vec_id % 10 = 1")
    assert told["lists"] == 24 and 1 <= told["probes"] < 24
    exact, got = {(q, i) for q, _, i in found(retrieval.nearest_for(asked, rows, 5))}, {(q, i) for q, _, i in found(index.search(asked, 5))}
    assert len(exact & got) >= 0.9 * len(exact)
    one = index.search(rows.where("vec_id = 5"), 3, 2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan.replace("isnotnull(list", "[list") or "list#" in plan.partition("PartitionFilters: [")[2].partition("]")[0]
    assert one.first()["vec_id"] == 5


def test_repeats_nulls_and_small_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None)], "vec_id long, embedding array<double>")
    index = VectorIndex.build(rows, str(tmp_path / "i"), lists=2)
    assert found(index.search(rows, 2, 2)) == [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2), (3, 1, 3), (3, 2, 1)]
    empty = VectorIndex.build(rows.where("vec_id > 3"), str(tmp_path / "e"))
    assert found(empty.search(rows, 2)) == []


def test_exact_search_block_after_block(spark):
    rows = clustered(spark, 200)
    asked = rows.where("vec_id % 3 = 0")
    many = retrieval.nearest_for(asked, rows, 3, block=20)
    assert found(many) == found(retrieval.nearest_for(asked, rows, 3)) and many.columns == ["query_id", "rank", "vec_id", "distance"]
    assert many.select(F.max("rank")).first()[0] == 3


def test_batches_do_not_grow_with_lists_and_probes(spark, tmp_path, monkeypatch):
    rows = clustered(spark, 400)
    index = VectorIndex.build(rows, str(tmp_path / "i"), lists=40)
    asked = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))

    class Asked:
        dtypes = asked.dtypes
        select = lambda self, *_: self
        mapInArrow = lambda self, work, _: work

    monkeypatch.setattr(vector_index, "PIECE_ROWS", 64)
    batches = list(index._nearest_lists(Asked(), 40, "l2", "query_id")(iter(asked.toArrow().to_batches())))
    assert sum(b.num_rows for b in batches) == 400 * 40 and max(b.num_rows for b in batches) <= 64
    bins, of = vector_index._bins({c: 10 for c in range(40)})
    once = index._nearest_lists(asked, 40, "l2", "query_id", bins=bins).collect()
    assert of == [400] and len(once) == 400 and all(r["bin"] == 0 and r["lists"] == list(range(40)) for r in once)
    monkeypatch.setattr(vector_index, "PART_ROWS", 30)
    bins, of = vector_index._bins({0: 10, 1: 50, 2: 20, 3: 10, 4: 1})
    assert bins == {0: 0, 1: 1, 2: 2, 3: 2, 4: 3} and of == [10, 50, 30, 1]
    some = index._nearest_lists(asked, 3, "l2", "query_id", bins=bins).collect()
    assert all(r["lists"] and all(bins[c] == r["bin"] for c in r["lists"]) for r in some)
