"""One query per operator: the operator, with production parameters, over its
whole table. ``SQL`` holds DuckDB text where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quill.llm import (covertree, decontaminate, dedup, eliasfano, gridcodes, htmltext, langid, lattice, ngram_join, packing, secrets, simplex,
                       toxicity)
from quill.llm.common import prepare, read


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return covertree.top_k(read(spark, sf_dir, "embeddings"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.classes(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op7_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lattice.score(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return eliasfano.token_id_table(read(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return gridcodes.codes(read(spark, sf_dir, "embeddings"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.identify(read(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simplex.cluster(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_array_dedup, op2_exact_top_k, op3_ngram_jaccard_join, op4_toxicity, op5_html_main_text, op6_secret_scan, op7_lattice_likelihood,
                            op8_decontamination, op9_best_fit_packing, op10_token_id_files, op11_vector_codes, op12_language_id, op13_centroid_clusters)}
_FINITE = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"
_SQUARES = "list_sum(list_transform(list_zip(r.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Vector codes: every part against every entry of its codebook."""
    near = ("SELECT r.id, r.p, min({d} * {n} + b.e) AS m FROM r JOIN b{i} b ON b.p = r.p GROUP BY r.id, r.p")
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED ({near.format(d=_SQUARES, n=entries, i=i)})")
        if i < rounds:
            steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT p, e, list(c ORDER BY pos) AS x FROM (
      SELECT p, e, pos, floor(sum(c) / count(*))::BIGINT AS c FROM (
        SELECT r.p, a.m % {entries} AS e, unnest(r.x) AS c, unnest(range(len(r.x))) AS pos FROM r JOIN a{i} a ON a.id = r.id AND a.p = r.p)
      GROUP BY p, e, pos) GROUP BY p, e) n ON n.p = b.p AND n.e = b.e)""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS id, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) > 0 AND {_FINITE})
), r AS MATERIALIZED (
  SELECT id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM k, range({parts}) t(p)
), b0 AS MATERIALIZED (SELECT p, id AS e, x FROM r WHERE id < {entries}),
{", ".join(steps)},
c AS (
  SELECT id, string_agg(printf('%02x', (m % {entries})::INTEGER), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error
  FROM a{rounds} GROUP BY id
), h AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM k JOIN c USING (id), h
"""


def _clusters_sql(k: int = 8, rounds: int = 10) -> str:
    """Centroid clusters: every vector against every centroid."""
    near = f"SELECT r.id, min({_SQUARES} * {k} + b.c) AS m FROM r, b{{i}} b GROUP BY r.id"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED ({near.format(i=i)})")
        if i < rounds:
            steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT b.c, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT c, list(y ORDER BY pos) AS x FROM (
      SELECT c, pos, floor(sum(y) / count(*))::BIGINT AS y FROM (
        SELECT a.m % {k} AS c, unnest(r.x) AS y, unnest(range(len(r.x))) AS pos FROM r JOIN a{i} a USING (id))
      GROUP BY c, pos) GROUP BY c) n ON n.c = b.c)""")
    return f"""
WITH r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS id, vec_id, x FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings WHERE len(embedding) = 64 AND {_FINITE})
), b0 AS MATERIALIZED (SELECT id AS c, x FROM r WHERE id < {k}),
{", ".join(steps)}
SELECT r.vec_id, (m % {k})::INTEGER AS cluster, m // {k} AS distance, sum(m // {k}) OVER (PARTITION BY m % {k})::BIGINT AS cluster_inertia,
       sum(m // {k}) OVER ()::BIGINT AS inertia, sha256(array_to_string(b.x, ',')) AS centroid_sha256
FROM r JOIN a{rounds} USING (id) JOIN b{rounds} b ON b.c = m % {k}
"""


SQL: dict[str, str] = {
    "op11_vector_codes": _codes_sql(),
    "op12_language_id": r"""
WITH z AS (
  SELECT list(t ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS t
    FROM range(256) b(i))
), d AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, lang, text, coalesce(xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 4 = 2, false) AS held_out FROM documents, z
), w AS MATERIALIZED (
  SELECT id, ' ' || word || ' ' AS word, count(*) AS n FROM (
    SELECT id, unnest(regexp_extract_all(lower(text), '\p{L}[\p{L}\p{M}]*')) AS word FROM d) GROUP BY ALL
), g AS MATERIALIZED (
  SELECT id, gram, sum(n)::BIGINT AS n FROM (
    SELECT id, n, substr(word, unnest(range(1, length(word) + 2 - size)), size) AS gram FROM w, range(1, 5) t(size))
  WHERE gram <> ' ' GROUP BY ALL
), p AS MATERIALIZED (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rank FROM (
    SELECT lang, gram, sum(n) AS n FROM g JOIN d USING (id) WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL)
  QUALIFY rank <= 400
), t AS MATERIALIZED (
  SELECT id, gram, rank() OVER (PARTITION BY id ORDER BY n DESC) AS rank FROM g QUALIFY rank <= 400
), s AS (
  SELECT f.id, l.lang, far - coalesce(near, 0) AS far FROM (SELECT id, 400 * count(*) AS far FROM t GROUP BY id) f CROSS JOIN (SELECT DISTINCT lang FROM p) l
  LEFT JOIN (SELECT id, p.lang, sum(400 - abs(t.rank - p.rank)) AS near FROM t JOIN p USING (gram) GROUP BY ALL) n ON n.id = f.id AND n.lang = l.lang
), b AS (
  SELECT id, lang, far, row_number() OVER (PARTITION BY id ORDER BY far, lang) AS place, lead(far) OVER (PARTITION BY id ORDER BY far, lang) AS next FROM s
)
SELECT d.doc_id, d.held_out, coalesce(b.lang, 'und') AS lang_pred,
       CASE WHEN b.far IS NULL THEN 0.0 WHEN next IS NULL THEN 1.0 WHEN far + next = 0 THEN 0.5 ELSE next::DOUBLE / (far + next)::DOUBLE END::DOUBLE AS score
FROM d LEFT JOIN b ON b.id = d.id AND b.place = 1
""",
    "op13_centroid_clusters": _clusters_sql(),
    "op2_exact_top_k": """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.rid AS query, q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM v q JOIN v d ON q.rid <> d.rid AND len(q.v) = len(d.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
""",
}
