"""A vector index of inverted lists: a coarse quantiser, lists as partitions, some of them probed, exact distances.

The centroids are fitted by k-means on a sample of ``SAMPLE_PER_LIST`` vectors a list, chosen
by a hash of the id; every vector is then put into the list of its nearest centroid. Lists are
partitions of the stored table, so a search reads those that its queries probe and no other.
Range partitions of (list, id) are written, so a list of any size is spread over tasks.

A search deals its queries to the lists that they probe. Small lists are put together in bins, so
a query is sent once to a bin with the names of its lists there. A bin is cut into parts of about
``PART_ROWS`` vectors and its queries into blocks of about ``BLOCK_QUERIES``; each part meets each
block in one group of bounded size, which keeps k rows for each query. With all lists probed
the result is the exact one.

How many lists are probed by default is measured once: for ``MEASURED`` of the vectors, chosen by
a hash of the id, an exhaustive search tells in which of their nearest lists the k nearest lie.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn import store
from cairn.operators.retrieval import _ranked, nearest_for, row_distances

SAMPLE_PER_LIST, ROUNDS, SEED = 128, 10, 3
#: Lists at most: the centroids are broadcast.
MOST_LISTS = 1 << 14
PART_ROWS, BLOCK_QUERIES = 20_000, 1_000
#: Distances to centroids worked out at once, and rows of a batch put out.
PIECE_CELLS, PIECE_ROWS = 1 << 18, 2_048
#: Queries of the measurement, neighbours of each, and the share of them to be found.
MEASURED, MEASURED_NEAR, RECALL = 200, 10, 0.95


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _normed(x: np.ndarray, metric: str) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if metric == "cosine" else x


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    @classmethod
    def build(cls, vectors: DataFrame, path: str, id_: str = "vec_id", vector: str = "embedding", metric: str = "l2", lists: int | None = None) -> VectorIndex:
        """Index the rows with a vector (of one length); ``lists``: by default about the square root of their number."""
        spark = vectors.sparkSession
        rows = vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("vector").isNotNull())
        n = rows.count()
        lists = min(MOST_LISTS, lists or max(1, round(n**0.5)))
        share = min(1.0, lists * SAMPLE_PER_LIST / max(1, n))
        scaled = F.transform("vector", lambda x: x / F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, y: s + y * y))) if metric == "cosine" else F.col("vector")
        sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(2 * lists * SAMPLE_PER_LIST).select(array_to_vector(scaled).alias("features"))
        centres = [c.tolist() for c in KMeans(k=lists, maxIter=ROUNDS, seed=SEED).fit(sample).clusterCenters()] if n else []
        spark.createDataFrame([(i, c) for i, c in enumerate(centres)], "list int, centre array<double>").coalesce(1).write.parquet(f"{path}/centres")
        index = cls(spark, path)
        listed = index._nearest_lists(rows, 1, metric, "id").select(F.col("bin").alias("list"), "id", "vector")
        listed.repartitionByRange("list", "id").sortWithinPartitions("list", "id").write.partitionBy("list").parquet(f"{path}/lists")
        sizes = index._lists().groupBy("list").count()
        sizes.coalesce(1).write.parquet(f"{path}/sizes")
        told = {"metric": metric, "id": id_, "vector": vector, "lists": len(centres), "rows": n}
        store.write_text(spark, f"{path}/index.json", json.dumps(told | {"probes": index._measured(metric) if n else 0}))
        return index

    def _measured(self, metric: str) -> int:
        """The least number of lists whose probing finds ``RECALL`` of the nearest rows of the measured queries."""
        rows = self._lists()
        asked = rows.orderBy(F.xxhash64("id"), "id").limit(MEASURED)
        exact = nearest_for(asked, rows.select("id", "vector"), MEASURED_NEAR, "vector", "id", metric)
        places = rows.select("id", "list").join(F.broadcast(exact.select("query_id", "id")), "id").select("query_id", "list").collect()  # MEASURED * MEASURED_NEAR
        names = {r["id"]: r["vector"] for r in asked.collect()}
        centres = self._centres()
        x = _normed(np.array(list(names.values()), np.float64), metric)
        order = np.argsort((centres * centres).sum(1)[None] - 2 * x @ centres.T, axis=1, kind="stable")
        rank = {name: {int(c): p for p, c in enumerate(row)} for name, row in zip(names, order, strict=True)}
        reached = np.sort([rank[r["query_id"]][r["list"]] for r in places])
        return int(reached[min(len(reached) - 1, int(np.ceil(RECALL * len(reached))) - 1)]) + 1

    def _centres(self) -> np.ndarray:
        return np.array([r["centre"] for r in self.spark.read.parquet(f"{self.path}/centres").orderBy("list").collect()])  # at most MOST_LISTS

    def described(self) -> dict:
        return json.loads(store.read_text(self.spark, f"{self.path}/index.json") or "null") or {}

    def _lists(self) -> DataFrame:
        return self.spark.read.schema("id long, vector array<double>, list int").parquet(f"{self.path}/lists")

    def _nearest_lists(self, rows: DataFrame, probes: int, metric: str, *keep: str, bins: dict[int, int] | None = None) -> DataFrame:
        """Each row once for each bin of its nearest lists, with those of the bin; by default every list is a bin.

        Nearness to a centroid is that of l2, for cosine between unit vectors. Rows are worked on and
        put out in pieces whose bytes depend neither on the number of lists nor on that of probes.
        """
        shared = self.spark.sparkContext.broadcast((self._centres(), bins))

        def work(batches):
            held, bins = shared.value
            of = np.arange(len(held)) if bins is None else np.array([bins.get(c, -1) for c in range(len(held))])
            n, size = min(probes, len(held)), (held * held).sum(-1)[None]
            for batch in batches:
                for at in range(0, batch.num_rows, step := max(1, min(1024, PIECE_CELLS // len(held)))):
                    part = batch.slice(at, step)
                    x = _normed(_matrix(part.column("vector")), metric)
                    far = size - 2 * x @ held.T
                    near = np.sort(np.argpartition(far, n - 1, axis=1)[:, :n], axis=1) if n < len(held) else np.broadcast_to(np.arange(n), far.shape)
                    row, near = np.repeat(np.arange(part.num_rows), n), near.ravel()
                    real = np.flatnonzero(of[near] >= 0)
                    real = real[np.lexsort((near[real], of[near[real]], row[real]))]
                    row, near, own = row[real], near[real].astype(np.int32), of[near[real]].astype(np.int32)
                    opens = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (own[1:] != own[:-1])])) if len(row) else np.zeros(0, np.int64)
                    ends = np.append(opens[1:], len(row))
                    for begin in range(0, len(opens), PIECE_ROWS):
                        some = slice(begin, begin + PIECE_ROWS)
                        first, stop = opens[some], ends[some]
                        lists = pa.ListArray.from_arrays(pa.array(np.append(first, stop[-1]) - first[0], pa.int32()), pa.array(near[first[0] : stop[-1]]))
                        picked = pa.array(row[first])
                        yield pa.RecordBatch.from_arrays([pa.array(own[first]), lists, *(part.column(c).take(picked) for c in (*keep, "vector"))], names=["bin", "lists", *keep, "vector"])

        kinds = dict(rows.dtypes)
        return rows.select(*keep, "vector").mapInArrow(work, "bin int, lists array<int>, " + ", ".join(f"{c} {kinds[c]}" for c in keep) + ", vector array<double>")

    def search(self, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
        """(query_id, rank, id, distance): the k nearest rows among the ``probes`` nearest lists of each query, with unique ids."""
        told = self.described()
        probes = probes or told["probes"]
        metric, id_ = told["metric"], told["id"]
        if not told["lists"]:
            return self.spark.createDataFrame([], f"query_id long, rank int, {id_} long, distance double")
        rows = queries.select(F.col(told["id"]).cast("long").alias("query_id"), F.col(told["vector"]).cast("array<double>").alias("vector")).where(F.col("vector").isNotNull())
        sizes = {r["list"]: r["count"] for r in self.spark.read.parquet(f"{self.path}/sizes").collect()}
        bins, rows_of = _bins(sizes)
        asked = self._nearest_lists(rows, probes, metric, "query_id", bins=bins)
        met = asked.select("bin", F.explode(F.concat("lists", F.array(F.lit(-1)))).alias("list")).groupBy("bin", "list").agg(F.count("*").alias("n")).collect()  # MOST_LISTS and the bins at most
        asking = {r["bin"]: r["n"] for r in met if r["list"] < 0}
        plan = [(r["bin"], r["list"], -(-rows_of[r["bin"]] // PART_ROWS), -(-asking[r["bin"]] // BLOCK_QUERIES)) for r in met if r["list"] >= 0]
        cuts = F.broadcast(self.spark.createDataFrame(plan, "bin int, list int, parts int, blocks int"))  # at most MOST_LISTS rows
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        held = self._lists().where(F.col("list").isin([p[1] for p in plan])).join(cuts, "list").select(
            "bin", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), every("blocks").alias("block"), "list", "id", "vector")
        met = asked.join(F.broadcast(cuts.select("bin", "parts", "blocks").distinct()), "bin").select(
            "bin", every("parts").alias("part"), F.pmod(F.xxhash64("query_id"), "blocks").cast("int").alias("block"), "query_id", "lists", "vector")

        def work(own: pa.Table, asking: pa.Table) -> pa.Table:
            out = {"query_id": [], "id": [], "distance": []}
            if own.num_rows and asking.num_rows:
                order = np.argsort(own.column("list").to_numpy(), kind="stable")
                ids, x, of = own.column("id").to_numpy()[order], _matrix(own.column("vector").combine_chunks())[order], own.column("list").to_numpy()[order]
                kinds = np.unique(of)
                begin, end = np.searchsorted(of, kinds), np.searchsorted(of, kinds, "right")
                lists = asking.column("lists").combine_chunks()
                for i, (name, q) in enumerate(zip(asking.column("query_id").to_pylist(), _matrix(asking.column("vector").combine_chunks()), strict=True)):
                    probed = np.isin(kinds, lists[i].values.to_numpy())
                    if not probed.any():
                        continue
                    place = slice(None) if probed.all() else np.concatenate([np.arange(a, z) for a, z in zip(begin[probed], end[probed], strict=True)])
                    some = ids[place]
                    far = row_distances(q[None], x[place], metric)
                    near = np.lexsort((some, far))[:k] if len(far) <= 4 * k else _least(far, some, k)
                    out["query_id"] += [name] * len(near)
                    out["id"] += some[near].tolist()
                    out["distance"] += far[near].tolist()
            return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "id": pa.array(out["id"], pa.int64()), "distance": pa.array(out["distance"], pa.float64())})

        key = ["bin", "part", "block"]
        found = held.groupBy(*key).cogroup(met.groupBy(*key)).applyInArrow(work, "query_id long, id long, distance double")
        return _ranked(found.withColumnRenamed("id", id_), id_, k)


def _bins(sizes: dict[int, int]) -> tuple[dict[int, int], list[int]]:
    """Lists in their order put together in bins of at most ``PART_ROWS`` rows, or of one list; and the rows of each bin."""
    bins, rows = {}, []
    for name, n in sorted(sizes.items()):
        if not rows or rows[-1] + n > PART_ROWS:
            rows.append(0)
        bins[name] = len(rows) - 1
        rows[-1] += n
    return bins, rows


def _least(far: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least distances, ties by id."""
    most = np.partition(far, k - 1)[k - 1]
    near = np.flatnonzero(far <= most)
    return near[np.lexsort((ids[near], far[near]))[:k]]
