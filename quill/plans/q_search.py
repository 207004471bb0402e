"""Search queries: F12, J1, W1, L5, P1-P3, A9 and the fake embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.operators import search as S
from quill.operators import embed as E
from quill.plans.registry import register
from quill.sources.tables import table


def label_centroids(spark, sf):
    """Query batch derived from the store: the mean vector of every label."""
    emb = table(spark, sf, "embeddings")
    return E.centroids(emb, "label", "embedding").withColumnRenamed("label", "query_id")


CENTROIDS_SQL = """
c AS (
  SELECT label AS query_id, list(x ORDER BY pos) AS qvec FROM (
    SELECT label, pos, avg(x) AS x FROM (
      SELECT label, unnest(embedding::DOUBLE[]) AS x, unnest(range(len(embedding))) AS pos
      FROM embeddings) GROUP BY label, pos)
  GROUP BY label)
"""


@register("j1_knn_topk", sql=f"""
WITH {CENTROIDS_SQL},
s AS (SELECT c.query_id, e.vec_id,
             round(list_cosine_similarity(e.embedding::DOUBLE[], c.qvec), 12) AS score
      FROM embeddings e CROSS JOIN c),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 5
""")
def j1_knn_topk(spark, sf):
    store = table(spark, sf, "embeddings")
    hits = S.knn_topk(store, label_centroids(spark, sf), k=5, id_col="vec_id", ordinal_col="vec_id")
    return hits.select("query_id", "vec_id", "score", "rank")


@register("l5_global_top_k", sql="""
WITH m AS (SELECT list(x ORDER BY pos) AS qvec FROM (
  SELECT pos, avg(x) AS x FROM (SELECT unnest(embedding::DOUBLE[]) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY pos)),
s AS (SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], m.qvec), 12) AS score FROM embeddings e, m)
SELECT vec_id, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s ORDER BY score DESC, vec_id LIMIT 10
""")
def l5_global_top_k(spark, sf):
    """The ten vectors nearest to the mean of all vectors: one query, scored where the store is scanned."""
    store = table(spark, sf, "embeddings")
    mean = E.centroids(store.withColumn("all", F.lit(0)), "all", "embedding").first()["embedding"]
    return S.top_k_one(store, mean, k=10, id_col="vec_id", ordinal_col="vec_id").select("vec_id", "score", "rank")


@register("j1_dealt_topk", sql="""
WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id % 10 = 0),
s AS (SELECT q.query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.qv), 12) AS score FROM embeddings e CROSS JOIN q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 5
""")
def j1_dealt_topk(spark, sf):
    """A batch of queries (every tenth vector) that is dealt in blocks instead of broadcast."""
    store = table(spark, sf, "embeddings")
    q = store.filter(F.pmod("vec_id", F.lit(10)) == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    hits = S.knn_topk(store, q, k=5, id_col="vec_id", ordinal_col="vec_id", broadcast_bytes=0)
    return hits.select("query_id", "vec_id", "score", "rank")


@register("f12_cosine_to_centroid", sql=f"""
WITH {CENTROIDS_SQL}
SELECT e.vec_id, e.label,
       round(CASE WHEN isnan(list_cosine_similarity(e.embedding::DOUBLE[], c.qvec)) THEN NULL
                  ELSE list_cosine_similarity(e.embedding::DOUBLE[], c.qvec) END, 6) AS score
FROM embeddings e JOIN c ON c.query_id = e.label
""")
def f12_cosine_to_centroid(spark, sf):
    """Every vector's cosine to its own label centroid (F12 as a column expression)."""
    emb = table(spark, sf, "embeddings")
    cent = label_centroids(spark, sf).withColumnRenamed("embedding", "qvec")
    # One centroid per label: the label domain bounds this side, AQE may broadcast it.
    j = emb.join(cent, emb.label == cent.query_id)
    return j.select("vec_id", "label", F.round(E.cosine_expr("embedding", "qvec"), 6).alias("score"))
