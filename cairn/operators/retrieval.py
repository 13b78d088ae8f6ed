"""Vector retrieval, pooling, context packing and keyword tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.session import work_dir

#: Words whose numbers of texts are broadcast, and words of a piece of a batch.
KNOWN_WORDS, PIECE_WORDS = 1 << 16, 1 << 19


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def distance(a: Column, b: Column, metric: str = "l2") -> Column:
    """``l2`` (squared), ``cosine`` (1 - similarity) or ``inner`` (negated product); smaller is nearer."""
    if metric == "l2":
        return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    if metric == "cosine":
        return 1 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    if metric == "inner":
        return -dot(a, b)
    raise ValueError(f"no such metric: {metric}")


def nearest(vectors: DataFrame, query: Sequence[float], k: int, vector: str = "embedding", id_: str = "vec_id", metric: str = "l2") -> DataFrame:
    """The k nearest rows to one vector, ties by id; each task keeps k rows."""
    return vectors.withColumn("distance", distance(F.col(vector), F.array(*[F.lit(float(x)) for x in query]), metric)).orderBy("distance", id_).limit(k)


def nearest_by(vectors: DataFrame, query: Sequence[float], k: int, by: str, vector: str = "embedding", id_: str = "vec_id", metric: str = "l2") -> DataFrame:
    """The k nearest rows of each group as (group, rank, id, distance).

    Partial top-k: rows are ranked within salted parts of a group first, so a large
    group is not ranked in one task.
    """
    from pyspark.sql import Window

    d = vectors.select(by, F.col(id_), distance(F.col(vector), F.array(*[F.lit(float(x)) for x in query]), metric).alias("distance"))
    order = ("distance", id_)
    salted = d.withColumn("_salt", F.pmod(F.xxhash64(id_), F.lit(64)))
    part = salted.withColumn("_r", F.row_number().over(Window.partitionBy(by, "_salt").orderBy(*order))).where(F.col("_r") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k).select(by, "rank", id_, "distance")


def nearest_for(queries: DataFrame, vectors: DataFrame, k: int, vector: str = "embedding", id_: str = "vec_id", metric: str = "l2", block: int = 100_000) -> DataFrame:
    """(query_id, rank, id, distance) for a stated set of queries, with unique ids, against all rows.

    The queries are taken in blocks of about ``block``, chosen by a hash of the id; each
    block is broadcast, and each task scans its vectors against it and keeps k rows for
    each query before anything is shuffled. Where there is more than one, block after block
    is searched and its result stored in the shared folder, so driver and executors hold one
    at a time. Products of matrices rule out vectors that are too far whatever the rounding;
    the distances of the others are worked out directly.
    """
    asked = queries.select(F.col(id_).alias("q"), F.col(vector).alias("v")).where(F.col(vector).isNotNull())
    blocks = max(1, -(-asked.count() // block))
    source = vectors.select(id_, vector).where(F.col(vector).isNotNull())
    if blocks == 1:
        return _ranked(_block_of(asked, source, id_, k, metric)[0], id_, k)
    folder, own = work_dir(queries.sparkSession, "nearest"), F.pmod(F.xxhash64("q"), F.lit(blocks))
    for b in range(blocks):
        found, shared = _block_of(asked.where(own == b), source, id_, k, metric)
        _ranked(found, id_, k).write.parquet(f"{folder}/block={b}")
        shared.destroy()
    return queries.sparkSession.read.parquet(folder).select("query_id", "rank", id_, "distance")


def _ranked(found: DataFrame, id_: str, k: int) -> DataFrame:
    """The k nearest of each query among the rows that tasks have kept."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", id_))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", id_, "distance")


def _block_of(asked: DataFrame, source: DataFrame, id_: str, k: int, metric: str) -> tuple[DataFrame, Broadcast]:
    work, shared = _nearest_in(asked, id_, k, metric)
    return source.mapInArrow(work, f"query_id long, {id_} long, distance double"), shared


def _nearest_in(asked: DataFrame, id_: str, k: int, metric: str):
    import numpy as np
    import pyarrow as pa

    rows = asked.collect()
    shared = asked.sparkSession.sparkContext.broadcast(([r["q"] for r in rows], np.array([r["v"] for r in rows], np.float64)))

    def direct(q, x):
        return row_distances(q, x, metric)

    def roughly(q, x):
        """Distances by products, and a bound on what rounding adds or takes."""
        if metric == "l2":
            qq, xx = (q * q).sum(1)[:, None], (x * x).sum(1)[None]
            return qq - 2 * q @ x.T + xx, 1e-12 * (qq + xx)
        if metric == "cosine":
            return 1 - (q @ x.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)), 1e-12
        return -(q @ x.T), 1e-12 * np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1))

    def work(batches):
        names, queries = shared.value
        best: dict[int, tuple] = {}
        for batch in (whole.slice(begin, 2048) for whole in batches for begin in range(0, whole.num_rows, 2048)):
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), np.array(batch.column(1).to_pylist(), np.float64)
            for at in range(0, len(names) if len(ids) else 0, 128):
                q = queries[at : at + 128]
                d, slack = roughly(q, x)
                least, most = d - slack, np.sort(d + slack, axis=1)[:, min(k, len(ids)) - 1]
                if at in best and best[at][0].shape[1] == k:
                    most = np.minimum(most, best[at][0][:, -1])
                row, column = np.nonzero(least <= most[:, None])
                near = np.full(d.shape, np.inf)
                near[row, column] = direct(q[row], x[column])
                far = np.broadcast_to(ids, d.shape)
                if at in best:
                    near, far = np.hstack([best[at][0], near]), np.hstack([best[at][1], far])
                order = np.lexsort((far, near), axis=1)[:, :k]
                best[at] = np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1)
        for at, (d, i) in best.items():
            real = np.isfinite(d.ravel())
            asked = np.repeat(names[at : at + 128], d.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(asked[real]), pa.array(i.ravel()[real]), pa.array(d.ravel()[real])], names=["query_id", id_, "distance"])

    return work, shared


def row_distances(q, x, metric: str):
    """Distance of each row of one matrix to the row beside it in the other."""
    import numpy as np

    if metric == "l2":
        return ((q - x) ** 2).sum(-1)
    dots = (q * x).sum(-1)
    return 1 - dots / (np.linalg.norm(q, axis=-1) * np.linalg.norm(x, axis=-1)) if metric == "cosine" else -dots


def pack(docs: DataFrame, by: Sequence[str], rank: str, size: str, id_: str, budget: int) -> DataFrame:
    """Greedy packing in rank order: a document that does not fit is skipped, later ones may fit.

    Groups can be of any length. The room left never grows, so once a document of some
    size does not fit, none of that size or larger does later: of each size n only the
    first budget / n documents of a group can be packed. The others are dropped in
    salted parts first, and the fold gets some budget * ln(budget) rows of a group at
    most, besides those of size zero, which are all part of the result. A null size
    never fits; a negative one is an error.
    """
    from pyspark.sql import Window

    n = F.col(size).cast("long")
    n = F.when(n < 0, F.raise_error(F.lit("negative size")).cast("long")).otherwise(n)
    able = docs.select(*by, n.alias("_n"), F.col(rank).alias("_rank"), F.col(id_).alias("_id")).where(F.col("_n") <= budget)
    fits = (F.col("_n") == 0) | (F.col("_r") * F.col("_n") <= budget)
    for salt in ([F.pmod(F.xxhash64("_id", "_rank"), F.lit(64))], []):
        order = Window.partitionBy(*by, "_n", *salt).orderBy("_rank", "_id")
        able = able.withColumn("_r", F.row_number().over(order)).where(fits).drop("_r")
    rows = able.select(*by, F.struct("_rank", F.col("_id").alias("id"), F.col("_n").alias("n")).alias("_doc")).unionByName(docs.select(*by).distinct(), allowMissingColumns=True)
    listed = rows.groupBy(*by).agg(F.array_sort(F.collect_list("_doc")).alias("_docs"))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast(f"array<{docs.schema[id_].dataType.simpleString()}>").alias("ids"))
    step = lambda held, d: F.when(held["total"] + d["n"] <= budget, F.struct((held["total"] + d["n"]).alias("total"), F.concat(held["ids"], F.array(d["id"])).alias("ids"))).otherwise(held)
    packed = listed.withColumn("_p", F.aggregate("_docs", start, step))
    return packed.select(*by, F.col("_p.total").alias("total"), F.col("_p.ids").alias("ids"))


def pool(tokens: Column, mode: str = "mean") -> Column:
    """One vector from an array of token vectors: mean, mean_sqrt, max, cls, weighted_mean or last."""
    fold = lambda xs, f: F.aggregate(F.slice(xs, F.lit(2), F.greatest(F.size(xs) - 1, F.lit(0))), F.transform(F.element_at(xs, 1), lambda v: v.cast("double")), lambda s, x: F.zip_with(s, x, f))
    n = F.size(tokens)
    if mode == "cls":
        return F.try_element_at(tokens, F.lit(1))
    if mode == "last":
        return F.try_element_at(tokens, F.lit(-1))
    if mode == "max":
        return fold(tokens, lambda a, b: F.greatest(a, b.cast("double")))
    if mode in ("mean", "mean_sqrt"):
        by = n.cast("double") if mode == "mean" else F.sqrt(n.cast("double"))
        return F.transform(fold(tokens, lambda a, b: a + b.cast("double")), lambda v: v / by)
    if mode == "weighted_mean":
        weighted = F.transform(tokens, lambda t, i: F.transform(t, lambda v: v.cast("double") * (i + 1)))
        return F.transform(fold(weighted, lambda a, b: a + b), lambda v: v / (n * (n + 1) / 2))
    raise ValueError(f"no such mode: {mode}")


def keywords(docs: DataFrame, id_: str, text: str, k: int = 5) -> DataFrame:
    """The k words of each text with the highest TF-IDF, ties by word: (id, rank, word, weight).

    Rows with one id are one text. Words are counted where their text lies. The numbers of
    texts of the most frequent words, ``KNOWN_WORDS`` at most, are broadcast; those of all others
    are between one and the largest that was left out. A word whose highest possible weight is below the k
    highest lowest ones of its text cannot be among its k, so only the others are shuffled,
    to be weighed by the exact numbers.
    """
    from pyspark.sql import Window

    listed = docs.select(id_, F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 1).alias("words"))
    again = docs.groupBy(id_).agg(F.count("*").alias("n")).where("n > 1").select(F.col(id_).alias("_again"))
    if not again.isEmpty():
        same = F.col(id_).eqNullSafe(F.col("_again"))
        several = listed.join(again, same, "left_semi").groupBy(id_).agg(F.flatten(F.collect_list("words")).alias("words"))
        listed = listed.join(again, same, "left_anti").unionByName(several)
    folder = work_dir(docs.sparkSession, "words")
    listed.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df")).write.parquet(folder)
    df = docs.sparkSession.read.schema("word string, df long").parquet(folder)
    n = docs.count()
    able = _able_words(listed, df, id_, k, n)
    weighted = able.join(df.hint("rebalance"), "word").withColumn("weight", F.col("tf") * (F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1))
    rank = F.row_number().over(Window.partitionBy(id_).orderBy(F.round("weight", 9).desc(), "word"))
    return weighted.withColumn("rank", rank).where(F.col("rank") <= k).select(id_, "rank", "word", "weight")


def _able_words(listed: DataFrame, df: DataFrame, id_: str, k: int, n: int) -> DataFrame:
    """(id, word, tf) of the words that may be among the k of their text."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    classes = df.groupBy("df").agg(F.count("*").alias("words")).orderBy(F.desc("df")).limit(KNOWN_WORDS + 1).collect()
    most, room = 0, KNOWN_WORDS  # the largest number of texts of a word that is not broadcast, 0 if all are
    for r in classes:
        room -= r["words"]
        if room < 0:
            most = r["df"]
            break
    held = {r["word"]: r["df"] for r in df.where(F.col("df") > most).collect()}  # KNOWN_WORDS at most
    shared = listed.sparkSession.sparkContext.broadcast((held, most or 1))

    def able(part: pa.RecordBatch) -> pa.RecordBatch:
        known, most = shared.value
        words = part.column(1).flatten().dictionary_encode()
        row = np.repeat(np.arange(part.num_rows), pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False))
        kinds = max(1, len(words.dictionary))
        pair, tf = np.unique(row * kinds + words.indices.to_numpy(), return_counts=True)
        row, word = pair // kinds, pair % kinds
        told = np.array([known.get(w, 0) for w in words.dictionary.to_pylist()], np.float64)[word] if len(pair) else np.zeros(0)
        weight = lambda texts: tf * (np.log((n + 1) / (texts + 1)) + 1)
        high, low = weight(np.where(told > 0, told, 1)), weight(np.where(told > 0, told, most))
        order = np.lexsort((-low, row))
        start = np.searchsorted(row, np.arange(part.num_rows))
        size = np.searchsorted(row, np.arange(part.num_rows), "right") - start
        least = np.full(part.num_rows, -np.inf)
        full = np.flatnonzero(size >= k)
        least[full] = low[order[start[full] + k - 1]]
        kept = np.flatnonzero(high >= least[row] - 1e-6)
        return pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row[kept])), words.dictionary.take(pa.array(word[kept])), pa.array(tf[kept].astype(np.int64))], names=[id_, "word", "tf"])

    def work(batches):
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < batch.num_rows:
                end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PIECE_WORDS, "right")))
                yield able(batch.slice(begin, end - begin))
                begin = end

    return listed.mapInArrow(work, f"`{id_}` {dict(listed.dtypes)[id_]}, word string, tf long")


def prompt(template: str, **parts: Column) -> Column:
    """A prompt with ``{name}`` places filled from columns."""
    import re

    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[parts[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def urls(text: Column) -> Column:
    """All web addresses in a text."""
    return F.regexp_extract_all(text, F.lit(r"(https?://[^\s<>\"']+)"), F.lit(1))
