"""Queries on vector retrieval and texts."""

from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import retrieval
from cairn.plans.registry import query
from cairn.operators.vector_index import VectorIndex
from cairn.session import table, work_dir

_L2 = "list_sum(list_transform(generate_series(1, 64), lambda i: (CAST(e.embedding[i] AS DOUBLE) - CAST(q.embedding[i] AS DOUBLE)) ** 2))"


def _first(spark, d):
    return table(spark, d, "embeddings").where("vec_id = 0").first()["embedding"]


@query(f"SELECT e.vec_id FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY {_L2}, e.vec_id LIMIT 10")
def vector_topk(spark, d):
    return retrieval.nearest(table(spark, d, "embeddings"), _first(spark, d), 10).select("vec_id")


@query(f"""SELECT label, CAST(rank AS INTEGER) AS rank, vec_id FROM (SELECT e.label, e.vec_id, row_number() OVER (PARTITION BY e.label ORDER BY {_L2}, e.vec_id) AS rank
FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q) WHERE rank <= 5""")
def vector_topk_by_label(spark, d):
    return retrieval.nearest_by(table(spark, d, "embeddings"), _first(spark, d), 5, "label").select("label", "rank", "vec_id")


@query(f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id FROM (SELECT q.vec_id AS query_id, e.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_L2}, e.vec_id) AS rank
FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 5""")
def vector_topk_queries(spark, d):
    """A stated query set, every fiftieth vector, against all rows."""
    e = table(spark, d, "embeddings")
    return retrieval.nearest_for(e.where("vec_id % 50 = 0"), e, 5).select("query_id", "rank", "vec_id")


@query(f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id FROM (SELECT q.vec_id AS query_id, e.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_L2}, e.vec_id) AS rank
FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 5""")
def vector_index_all(spark, d):
    """The same from an index, with every list probed."""
    e = table(spark, d, "embeddings")
    index = VectorIndex.build(e, work_dir(spark, "index"))
    return index.search(e.where("vec_id % 50 = 0"), 5, index.described()["lists"]).select("query_id", "rank", "vec_id")


@query("SELECT count(*) * 5 AS wanted, TRUE AS enough FROM embeddings WHERE vec_id % 50 = 0")
def vector_index_recall(spark, d):
    """With the measured number of probes: of the five nearest of every fiftieth vector at least nine tenths are found."""
    e = table(spark, d, "embeddings")
    index, asked = VectorIndex.build(e, work_dir(spark, "index")), e.where("vec_id % 50 = 0")
    exact = retrieval.nearest_for(asked, e, 5).select("query_id", "vec_id")
    found = index.search(asked, 5).select("query_id", "vec_id", F.lit(1).alias("hit"))
    return exact.join(found, ["query_id", "vec_id"], "left").agg(F.count("*").alias("wanted"), (F.sum("hit") >= 0.9 * F.count("*")).alias("enough"))


@query("""WITH RECURSIVE d AS (SELECT source, doc_id, n_chars AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
p AS (SELECT DISTINCT source, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS total, CAST([] AS BIGINT[]) AS ids FROM documents
 UNION ALL SELECT p.source, d.r, CASE WHEN p.total + d.n <= 2000 THEN p.total + d.n ELSE p.total END, CASE WHEN p.total + d.n <= 2000 THEN list_append(p.ids, d.doc_id) ELSE p.ids END
 FROM p JOIN d ON d.source = p.source AND d.r = p.r + 1)
SELECT source, arg_max(total, r) AS total, arg_max(ids, r) AS ids FROM p GROUP BY source""")
def context_pack(spark, d):
    """Documents of each source by id, packed into 2000 characters."""
    return retrieval.pack(table(spark, d, "documents"), ["source"], "doc_id", "n_chars", "doc_id", 2000)


@query("""SELECT doc_id, CAST(c AS BIGINT) AS chunk_no, CAST(c * 900 AS BIGINT) AS begin, substring(text, CAST(c * 900 + 1 AS BIGINT), 1000) AS chunk
FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(CAST(ceil((length(text) - 100) / 900.0) AS BIGINT), 1) - 1)) AS c FROM documents WHERE length(text) > 0)""")
def text_chunk(spark, d):
    return text.chunks(table(spark, d, "documents"), "doc_id", "text")


_C = "\"''’”」』"


@query(rf"""WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '(?:((?:\.{{3,}}|…+|[。！？!?;；]+)[{_C}]*|\.[{_C}]+)\s*|(\.)(?:\s+|$))', '\1\2' || chr(10), 'g'), chr(10) || '+'), lambda s: trim(s)), lambda s: s <> '') AS parts FROM documents)
SELECT doc_id, CAST(i AS INTEGER) AS sentence_no, parts[i + 1] AS sentence FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM p)""")
def sentence_split(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("sentence_no", "sentence"))


@query(r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: length(w) > 1)) AS word FROM documents),
tf AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL), df AS (SELECT word, count(*) AS df FROM tf GROUP BY word), n AS (SELECT count(*) AS n FROM documents)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, word FROM (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY round(tf * (ln((n + 1) / (df + 1)) + 1), 9) DESC, word) AS rank FROM tf JOIN df USING (word), n) WHERE rank <= 5""")
def keyword_tags(spark, d):
    return retrieval.keywords(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "rank", "word")


_MODES = ("mean", "mean_sqrt", "max", "cls", "weighted_mean", "last")


@query("""WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[64] AS DOUBLE) AS z FROM embeddings WHERE embedding IS NOT NULL)
SELECT vec_id, mode, round(f, 6) AS first, round(l, 6) AS last FROM (SELECT vec_id, unnest(['mean', 'mean_sqrt', 'max', 'cls', 'weighted_mean', 'last']) AS mode,
 unnest([(a + z) / 2, (a + z) / sqrt(2), greatest(a, z), a, (a + 2 * z) / 3, z]) AS f, unnest([(a + z) / 2, (a + z) / sqrt(2), greatest(a, z), z, (z + 2 * a) / 3, a]) AS l FROM e)""")
def pooled_vectors(spark, d):
    """A vector and its reverse as the two tokens of a pooled vector, by every mode: its first and last component."""
    e = table(spark, d, "embeddings").where("embedding IS NOT NULL").withColumn("tokens", F.array("embedding", F.reverse("embedding")))
    pools = F.array(*[F.struct(F.lit(m).alias("mode"), F.transform(retrieval.pool(F.col("tokens"), m), lambda v: v.cast("double")).alias("v")) for m in _MODES])
    return e.select("vec_id", F.explode(pools).alias("p")).select(
        "vec_id", "p.mode", F.round(F.element_at("p.v", 1), 6).alias("first"), F.round(F.element_at("p.v", -1), 6).alias("last"))


@query("""SELECT page_id, url AS first_url FROM pages WHERE url IS NOT NULL""")
def prompt_urls(spark, d):
    filled = retrieval.prompt("see {url} for page {id}", url=F.col("url"), id=F.col("page_id").cast("string"))
    return table(spark, d, "pages").where("url IS NOT NULL").select("page_id", F.element_at(retrieval.urls(filled), 1).alias("first_url"))
