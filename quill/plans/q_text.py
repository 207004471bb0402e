"""Text path queries: F1-F5, A1-A2, J9, S7-S8, W3, F20-F21, F13-F15, W2 and the
end-to-end search."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.functions import text as TX
from quill.operators import bundle as B
from quill.operators import chunk as C
from quill.operators import embed as E
from quill.operators import search as S
from quill.operators import tokens as T
from quill.operators.extract import html_to_text
from quill.plans.registry import register
from quill.session import ensure_checkpoint_dir
from quill.sources import store as ST
from quill.sources.tables import stored, table

# SQL spellings of the native tokenizer (RE2 reads these like Java does).
TOKEN_SQL = r"'[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r]'"
WORD_SQL = r"'[\p{L}\p{N}_]+'"
PIECE_SQL = r"'(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r])[ \t\n\x0B\f\r]*'"


@register("f3_count_tokens", sql=f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, {TOKEN_SQL})) AS INTEGER) AS n_tokens FROM documents
""")
def f3_count_tokens(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", TX.count_tokens("text").alias("n_tokens"))


@register("a1_tokens_by_lang", sql=f"""
SELECT lang, count(*) AS n_docs,
       CAST(sum(len(regexp_extract_all(text, {TOKEN_SQL}))) AS BIGINT) AS total_tokens
FROM documents GROUP BY ROLLUP (lang)
""")
def a1_tokens_by_lang(spark, sf):
    d = T.with_token_counts(table(spark, sf, "documents").select("lang", "text"))
    return T.tokens_by(d, "lang")


MODELS_SQL = "['gpt-4o','gpt-4','gpt-3.5','codex','davinci','claude-3.5','claude-3','o200k_base','mystery-model']"


def _docs_with_model(spark, sf):
    # Derived input: each document is counted for one of nine model names
    # (the seven mapped ones, a bare encoding name and an unknown name).
    models = F.array(*[F.lit(m) for m in ["gpt-4o", "gpt-4", "gpt-3.5", "codex", "davinci",
                                         "claude-3.5", "claude-3", "o200k_base", "mystery-model"]])
    d = table(spark, sf, "documents")
    return d.withColumn("model", F.element_at(models, (F.pmod("doc_id", F.lit(9)) + 1).cast("int")))


@register("a2_token_report", sql=f"""
WITH d AS (SELECT {MODELS_SQL}[(doc_id % 9) + 1] AS model, text FROM documents),
m AS (SELECT * FROM (VALUES ('gpt-4o','o200k_base'),('gpt-4','cl100k_base'),('gpt-3.5','cl100k_base'),
        ('codex','p50k_base'),('davinci','r50k_base'),('claude-3.5','cl100k_base'),('claude-3','cl100k_base')) t(model, enc)),
e AS (SELECT d.model, coalesce(m.enc, CASE WHEN d.model IN ('gpt2','r50k_base','p50k_base','p50k_edit','cl100k_base','o200k_base')
        THEN d.model END, 'cl100k_base') AS encoding, d.text FROM d LEFT JOIN m ON d.model = m.model),
a AS (SELECT model, encoding, count(*) AS files, CAST(sum(length(text)) AS BIGINT) AS total_chars,
        CAST(sum(len(regexp_extract_all(text, {TOKEN_SQL}))) AS BIGINT) AS total_tokens FROM e GROUP BY model, encoding)
SELECT *, CASE WHEN total_tokens > 0 THEN round(total_chars / total_tokens, 2) END AS chars_per_token FROM a
""")
def a2_token_report(spark, sf):
    d = T.resolve_encoding(_docs_with_model(spark, sf))
    return T.token_report(d, ["model", "encoding"])


@register("j9_model_encoding", sql=f"""
WITH d AS (SELECT doc_id, {MODELS_SQL}[(doc_id % 9) + 1] AS model FROM documents),
m AS (SELECT * FROM (VALUES ('gpt-4o','o200k_base'),('gpt-4','cl100k_base'),('gpt-3.5','cl100k_base'),
        ('codex','p50k_base'),('davinci','r50k_base'),('claude-3.5','cl100k_base'),('claude-3','cl100k_base')) t(model, enc))
SELECT d.doc_id, d.model, coalesce(m.enc, CASE WHEN d.model IN ('gpt2','r50k_base','p50k_base','p50k_edit','cl100k_base','o200k_base')
        THEN d.model END, 'cl100k_base') AS encoding
FROM d LEFT JOIN m ON d.model = m.model
""")
def j9_model_encoding(spark, sf):
    return T.resolve_encoding(_docs_with_model(spark, sf).select("doc_id", "model")).select("doc_id", "model", "encoding")


@register("f2_collapse_blank_runs", sql=r"""
WITH d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, chr(10), chr(10) || chr(10) || chr(10))
                                          WHEN 1 THEN chr(10) || chr(10) || text || chr(10) || chr(10) || chr(10)
                                          ELSE text END AS t FROM documents),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS x FROM d)
SELECT doc_id, md5(x) AS text_md5, CAST(length(x) AS INTEGER) AS n_chars FROM c
""")
def f2_collapse_blank_runs(spark, sf):
    d = table(spark, sf, "documents")
    nl = "\n"
    t = (F.when(F.pmod("doc_id", F.lit(3)) == 0, F.replace(F.col("text"), F.lit(nl), F.lit(nl * 3)))
         .when(F.pmod("doc_id", F.lit(3)) == 1, F.concat(F.lit(nl * 2), F.col("text"), F.lit(nl * 3)))
         .otherwise(F.col("text")))
    x = TX.collapse_blank_runs(t)
    return d.select("doc_id", F.md5(x).alias("text_md5"), F.length(x).alias("n_chars"))


@register("f5_window_split", sql=f"""
WITH p AS (SELECT doc_id, lang, regexp_extract_all(text, {PIECE_SQL}) AS pcs FROM documents),
w AS (SELECT doc_id, lang, pcs, unnest(range(0, greatest(len(pcs) - 20 - 1, 0) + 1, 180)) AS s FROM p WHERE len(pcs) > 0),
c AS (SELECT doc_id, lang, CAST(s / 180 AS INTEGER) AS chunk_index, list_slice(pcs, s + 1, s + 200) AS win FROM w)
SELECT doc_id, lang, chunk_index, CAST(len(win) AS INTEGER) AS n_tokens,
       md5(regexp_replace(array_to_string(win, ''), '[ \\t\\n\\x0B\\f\\r]+$', '')) AS text_md5
FROM c
""")
def f5_window_split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    ch = C.split_windows(d, size=200, overlap=20)
    return ch.select("doc_id", "lang", "chunk_index", "n_tokens", F.md5("text").alias("text_md5"))


@register("a1_chunk_tokens_per_doc", sql=f"""
WITH p AS (SELECT doc_id, regexp_extract_all(text, {PIECE_SQL}) AS pcs FROM documents),
w AS (SELECT doc_id, pcs, unnest(range(0, greatest(len(pcs) - 20 - 1, 0) + 1, 180)) AS s FROM p WHERE len(pcs) > 0)
SELECT doc_id, count(*) AS n_chunks, CAST(sum(len(list_slice(pcs, s + 1, s + 200))) AS BIGINT) AS chunk_tokens,
       CAST(max(len(pcs)) AS INTEGER) AS doc_tokens
FROM w GROUP BY doc_id
""")
def a1_chunk_tokens_per_doc(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    # one tokenizing pass: the windows carry their document's token count
    ch = C.split_windows(d, size=200, overlap=20, doc_tokens_col="doc_tokens")
    return ch.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"),
                                    F.sum("n_tokens").cast("bigint").alias("chunk_tokens"),
                                    F.max("doc_tokens").alias("doc_tokens"))


@register("f1_html_to_text", sql=r"""
WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN 'Title' || text || ' tail & end' WHEN 2 THEN text || ' <b> & more' ELSE text || 'last' || chr(10) END AS t
           FROM documents),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS x FROM t)
SELECT doc_id, md5(x) AS text_md5, CAST(length(x) AS INTEGER) AS n_chars FROM c
""")
def f1_html_to_text(spark, sf):
    """F1 on pages made of the documents: the selected element among others, a page without
    it, two of them with references and a comment, and one that is never closed."""
    d = table(spark, sf, "documents")
    safe = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    k = F.pmod("doc_id", F.lit(4))
    page = lambda a, b: F.concat(F.lit(a), safe, F.lit(b))
    html = (F.when(k == 0, page('<html><head><title>T</title><style>p {}</style></head><body><nav>menu</nav><article class="x md-content__inner">',
                                "</article><footer>foot</footer></body></html>"))
            .when(k == 1, page("<html><title>Title</title><body><p>", "</p><script>var x = '<p>';</script> tail &amp; end<template>no</template></body></html>"))
            .when(k == 2, page('<article>no</article><article class="md-content__inner"><p>',
                               '</p> &lt;b&gt; &#38; more<!-- never --></article><article class="md-content__inner">second</article>'))
            .otherwise(page('<div>out</div><article class="md-content__inner"><p>', "<br>last\n")))
    x = html_to_text(html)
    return d.select("doc_id", x.alias("x")).select("doc_id", F.md5("x").alias("text_md5"), F.length("x").alias("n_chars"))


@register("f4_split_whole_texts", sql=f"""
SELECT doc_id, md5(regexp_replace(text, '\\s+', '', 'g')) AS joined_md5, true AS fits,
       CAST(len(regexp_extract_all(text, {TOKEN_SQL})) AS BIGINT) AS tokens
FROM documents WHERE len(regexp_extract_all(text, {TOKEN_SQL})) > 0
""")
def f4_split_whole_texts(spark, sf):
    """F4 without overlap: a document's chunks joined are its text but for white space at
    their borders, none is longer than the size, and their tokens add up."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    ch = C.split_recursive(d, size=100, overlap=0)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))), lambda r: r["text"]), "")
    return ch.groupBy("doc_id").agg(F.md5(F.regexp_replace(joined, r"\s+", "")).alias("joined_md5"), F.bool_and(F.col("n_tokens") <= 100).alias("fits"),
                                    F.sum("n_tokens").alias("tokens"))


@register("f4_recursive_split")
def f4_recursive_split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return C.split_recursive(d, size=200, overlap=20)


@register("s7_w3_document_bundle", sql="""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS ordinal FROM documents)
SELECT lang, ordinal,
       md5('Document ' || ordinal || ': ' || coalesce(source, 'Unknown URL') || chr(10) || repeat('-', 80) || chr(10)
           || text || chr(10) || chr(10) || repeat('=', 80) || chr(10) || chr(10)) AS block_md5
FROM o
""")
def s7_w3_document_bundle(spark, sf):
    d = table(spark, sf, "documents")
    r = B.render_documents(d, module_col="lang")
    return r.select("lang", "ordinal", F.md5("block").alias("block_md5"))


@register("s8_f20_toc_bundle", sql=r"""
WITH f AS (SELECT lang || '/' || source || '/doc-' || doc_id || '.md' AS path, text FROM documents),
r AS (SELECT path, text, row_number() OVER (ORDER BY path) - 1 AS rank FROM f),
a AS (SELECT *, 'file-' || replace(replace(lower(path), '/', '-'), '.', '-') AS anc FROM r),
lines AS (
  SELECT 0 AS section, 0 AS rank, 0 AS sub, '# Table of Contents' || chr(10) AS line
  UNION ALL SELECT 1, 4611686018427387904, 0, chr(10) || '---' || chr(10)
  UNION ALL SELECT 1, rank, 0, '- [.ai/' || path || '](#' || anc || ')' FROM a
  UNION ALL SELECT 2, rank, 0, '<h1 id=''' || anc || '''>.ai/' || path || '</h1>' || chr(10) FROM a
  UNION ALL SELECT 2, rank, 1, regexp_replace(text, '^\s+|\s+$', '', 'g') FROM a
  UNION ALL SELECT 2, rank, 2, chr(10) || chr(10) || '---' || chr(10) || chr(10) FROM a)
SELECT CAST(section AS INTEGER) AS section, CAST(rank AS BIGINT) AS rank, CAST(sub AS INTEGER) AS sub, md5(line) AS line_md5 FROM lines
""")
def s8_f20_toc_bundle(spark, sf):
    d = table(spark, sf, "documents")
    files = d.select(F.concat_ws("/", "lang", "source", F.concat(F.lit("doc-"), F.col("doc_id"), F.lit(".md"))).alias("path"), "text")
    rows = B.toc_bundle(files)
    return rows.select("section", "rank", "sub", F.md5("line").alias("line_md5"))


@register("f21_line_range", sql=r"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS segs, text FROM documents),
l AS (SELECT doc_id, segs, CASE WHEN suffix(text, chr(10)) THEN list_slice(segs, 1, len(segs) - 1) ELSE segs END AS lines FROM s),
x AS (SELECT doc_id, segs, list_slice(lines, 2, 4) AS sl FROM l)
SELECT doc_id, array_to_string(sl, chr(10)) AS lines_1_4,
       array_to_string(sl, chr(10) || chr(10)) || CASE WHEN len(sl) > 0 AND 1 + len(sl) < len(segs) THEN chr(10) ELSE '' END AS legacy_1_4
FROM x
""")
def f21_line_range(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", TX.line_range("text", 1, 4).alias("lines_1_4"),
                    TX.line_range("text", 1, 4, legacy=True).alias("legacy_1_4"))


@register("p5_a10_line_classes", sql=r"""
WITH c AS (SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 0
                             WHEN suffix(text, chr(10)) THEN len(string_split(text, chr(10))) - 1
                             ELSE len(string_split(text, chr(10))) END AS n_lines FROM documents)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines,
       CASE WHEN n_lines > 250 THEN 'over_max' WHEN n_lines > 120 THEN 'over_target' ELSE 'within' END AS line_class,
       n_lines > 120 AS strict_fail
FROM c
""")
def p5_a10_line_classes(spark, sf):
    from quill.operators.headers import line_limit_class
    d = table(spark, sf, "documents")
    return line_limit_class(d.select("doc_id", TX.line_count("text").alias("n_lines")), "n_lines")


@register("f13_index_embedding", sql="""
SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS DOUBLE) AS last_value, 10 AS dim, CAST(9.0 AS DOUBLE) AS head_sum FROM documents
""")
def f13_index_embedding(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    e = E.IndexEmbedder("doc_id").embed(d)
    return e.select("doc_id", F.element_at("embedding", -1).alias("last_value"), F.size("embedding").alias("dim"),
                    F.aggregate(F.slice("embedding", 1, 9), F.lit(0.0), lambda a, x: a + x).alias("head_sum"))


@register("w2_f14_consistent_embedding", sql="""
WITH f AS (SELECT text, min(doc_id) AS first_pos FROM documents GROUP BY text),
r AS (SELECT text, row_number() OVER (ORDER BY first_pos) - 1 AS fs FROM f)
SELECT d.doc_id, CAST(r.fs AS DOUBLE) AS last_value, 16 AS dim FROM documents d JOIN r ON d.text = r.text
""")
def w2_f14_consistent_embedding(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    e = E.ConsistentEmbedder("doc_id", dim=16).embed(d)
    return e.select("doc_id", F.element_at("embedding", -1).alias("last_value"), F.size("embedding").alias("dim"))


@register("f15_angular_embedding", sql="""
WITH a AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN 'angle-' || p_size ELSE CAST(p_size / 50.0 AS VARCHAR) END AS t FROM part),
v AS (SELECT p_partkey, t, TRY_CAST(trim(t) AS DOUBLE) AS x FROM a)
SELECT p_partkey, t AS angle_text,
       round(CASE WHEN x IS NULL THEN 0.0 ELSE cos(x * pi()) END, 9) AS e0,
       round(CASE WHEN x IS NULL THEN 0.0 ELSE sin(x * pi()) END, 9) AS e1
FROM v
""")
def f15_angular_embedding(spark, sf):
    p = table(spark, sf, "part")
    t = F.when(F.pmod("p_partkey", F.lit(13)) == 0, F.concat(F.lit("angle-"), F.col("p_size").cast("string"))) \
        .otherwise((F.col("p_size") / F.lit(50.0)).cast("string"))
    a = E.AngularEmbedder().embed(p.select("p_partkey", t.alias("angle_text")), "angle_text")
    return a.select("p_partkey", "angle_text", F.round(F.col("embedding")[0], 9).alias("e0"),
                    F.round(F.col("embedding")[1], 9).alias("e1"))


def _doc_chunks(spark, sf, size=200, overlap=20):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    ch = C.split_windows(d, size=size, overlap=overlap)
    return ch.withColumn("chunk_id", F.col("doc_id") * 2147483648 + F.col("chunk_index")) \
             .withColumn("ordinal", F.col("chunk_id"))


def _hash_vec_sql(col: str, dim: int) -> str:
    return (f"list_transform(range({dim}), lambda i: CAST(len(list_filter(list_transform(regexp_extract_all(lower({col}), {WORD_SQL}), "
            f"lambda t: CAST(('0x' || substr(md5(t), 1, 8))::UBIGINT % {dim} AS BIGINT)), lambda b: b = i)) AS DOUBLE))")


@register("j1_text_search", sql=f"""
WITH p AS (SELECT doc_id, regexp_extract_all(text, {PIECE_SQL}) AS pcs FROM documents),
w AS (SELECT doc_id, pcs, unnest(range(0, greatest(len(pcs) - 20 - 1, 0) + 1, 180)) AS s FROM p WHERE len(pcs) > 0),
c AS (SELECT doc_id * 2147483648 + CAST(s / 180 AS BIGINT) AS chunk_id,
             regexp_replace(array_to_string(list_slice(pcs, s + 1, s + 200), ''), '[ \\t\\n\\x0B\\f\\r]+$', '') AS text FROM w),
cv AS (SELECT chunk_id, {_hash_vec_sql('text', 64)} AS v FROM c),
q AS (SELECT item_id AS query_id, {_hash_vec_sql('text', 64)} AS qv FROM benchmark),
s AS (SELECT q.query_id, cv.chunk_id,
             round(CASE WHEN isnan(list_cosine_similarity(cv.v, q.qv)) THEN NULL ELSE list_cosine_similarity(cv.v, q.qv) END, 12) AS score
      FROM cv CROSS JOIN q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, chunk_id) AS INTEGER) AS rank FROM s)
SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM r WHERE rank <= 3
""")
def j1_text_search(spark, sf):
    emb = E.HashingEmbedder(dim=64)
    store = emb.embed(_doc_chunks(spark, sf))
    qs = emb.embed(table(spark, sf, "benchmark").withColumnRenamed("item_id", "query_id"))
    return S.knn_topk(store, qs, k=3, id_col="chunk_id", ordinal_col="chunk_id").select("query_id", "chunk_id", "score", "rank")


def _user_queries(spark, sf):
    c = table(spark, sf, "conversations").filter(F.col("role") == "user")
    return c.select(F.concat_ws(":", "conv_id", "turn").alias("query_id"), F.col("text").alias("query"))


@register("p1_blank_queries", sql=r"""
WITH q AS (SELECT conv_id || ':' || turn AS query_id,
                  CASE WHEN conv_id % 10 = 0 THEN '  ' || chr(10) || ' ' ELSE text END AS query
           FROM conversations WHERE role = 'user')
SELECT query_id, CASE WHEN query IS NULL OR length(regexp_replace(query, '^\s+|\s+$', '', 'g')) = 0
                      THEN 'Query cannot be empty' END AS error FROM q
""")
def p1_blank_queries(spark, sf):
    c = table(spark, sf, "conversations").filter(F.col("role") == "user")
    # Derived input: blank queries injected for every tenth conversation.
    q = c.select(F.concat_ws(":", "conv_id", "turn").alias("query_id"),
                 F.when(F.pmod("conv_id", F.lit(10)) == 0, F.lit("  \n ")).otherwise(F.col("text")).alias("query"))
    return S.query_errors(q, "query").select("query_id", "error")


@register("p2_config_rules", sql="""
WITH c AS (SELECT p_partkey, CAST(p_size % 13 - 1 AS INTEGER) AS k, (p_retailprice - 900.0) / 1000.0 AS min_relevance_score FROM part)
SELECT p_partkey, k, min_relevance_score,
       CASE WHEN k IS NULL OR k < 1 THEN 'k must be >= 1'
            WHEN k > 10 THEN 'k cannot be greater than 10 to prevent excessive token usage'
            WHEN min_relevance_score IS NULL OR min_relevance_score < 0 OR min_relevance_score > 1
              THEN 'min_relevance_score must be between 0 and 1' END AS error
FROM c
""")
def p2_config_rules(spark, sf):
    p = table(spark, sf, "part")
    cfg = p.select("p_partkey", (F.pmod("p_size", F.lit(13)) - 1).cast("int").alias("k"),
                   ((F.col("p_retailprice") - 900.0) / 1000.0).alias("min_relevance_score"))
    return S.config_errors(cfg)


@register("p3_a9_response_pack", sql=f"""
WITH {'''c AS (
  SELECT label AS query_id, list(x ORDER BY pos) AS qvec FROM (
    SELECT label, pos, avg(x) AS x FROM (
      SELECT label, unnest(embedding::DOUBLE[]) AS x, unnest(range(len(embedding))) AS pos
      FROM embeddings) GROUP BY label, pos)
  GROUP BY label)'''},
s AS (SELECT c.query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], c.qvec), 12) AS score
      FROM embeddings e CROSS JOIN c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, vec_id) AS rank FROM s),
t AS (SELECT * FROM r WHERE rank <= 10)
SELECT query_id,
       string_agg(CASE WHEN coalesce(score, 1.0) >= 0.3 THEN CAST(vec_id AS VARCHAR) END, ',' ORDER BY rank) AS documents,
       CAST(count(*) FILTER (WHERE coalesce(score, 1.0) >= 0.3) AS INTEGER) AS n_kept,
       count(*) AS total_found
FROM t GROUP BY query_id
""")
def p3_a9_response_pack(spark, sf):
    from quill.plans.q_search import label_centroids
    store = table(spark, sf, "embeddings")
    hits = S.knn_topk(store, label_centroids(spark, sf), k=10, id_col="vec_id", ordinal_col="vec_id")
    hits = hits.withColumn("doc", F.col("vec_id").cast("string"))
    pack = S.response_pack(hits, "doc", min_relevance_score=0.3)
    return pack.select("query_id", F.nullif(F.array_join("documents", ","), F.lit("")).alias("documents"),
                       F.size("scores").alias("n_kept"), "total_found")


@register("e2e_search")
def e2e_search(spark, sf):
    """pages -> F1 -> F5 -> hashing embedding -> store rows -> top-2 answers for user turns."""
    pages = table(spark, sf, "pages")
    docs = pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("source"),
                        html_to_text(F.col("html"), selector="article").alias("text"))
    chunks = C.split_windows(docs, size=256, overlap=32)
    chunks = chunks.withColumn("chunk_id", F.col("doc_id") * 2147483648 + F.col("chunk_index")) \
                   .withColumn("ordinal", F.col("chunk_id"))
    emb = E.HashingEmbedder(dim=256, hash_fn="xxhash64")
    # Build once, then search: like the reference's persisted store, the rows
    # are written (in columns, to the session's checkpoint folder) so the scoring scan
    # and the payload lookup do not both redo extraction and embedding.
    store = stored(emb.embed(chunks), "store")
    qs = S.query_errors(_user_queries(spark, sf), "query").filter(F.col("error").isNull())
    qs = stored(emb.embed(qs, "query").select("query_id", "embedding"), "queries")
    return S.search(store, qs, k=2, text_col="text")


def _captures(spark, sf):
    """Derived input: every document as a captured page, and a later, shorter capture of every fourth."""
    d = table(spark, sf, "documents")

    def page(text):
        safe = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return d.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("https://docs.example.com/"), "doc_id").alias("url"),
                        F.concat(F.lit("<html><body><article>"), safe, F.lit("</article></body></html>")).alias("html"))

    return page(F.col("text")), page(F.expr("substr(text, 1, length(text) div 2)")).filter(F.pmod("page_id", F.lit(4)) == 0)


@register("e1_streaming_ingest", sql=rf"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN substr(text, 1, length(text) // 2) ELSE text END AS t FROM documents),
x AS (SELECT doc_id, regexp_replace(regexp_replace(t, '

+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM d),
p AS (SELECT doc_id, regexp_extract_all(text, {PIECE_SQL}) AS pcs FROM x),
w AS (SELECT doc_id, pcs, unnest(range(0, greatest(len(pcs) - 32 - 1, 0) + 1, 224)) AS s FROM p WHERE len(pcs) > 0)
SELECT doc_id * 2147483648 + CAST(s / 224 AS BIGINT) AS chunk_id, doc_id * 2147483648 + CAST(s / 224 AS BIGINT) AS ordinal, 'web' AS module,
       256 AS dim, md5(regexp_replace(array_to_string(list_slice(pcs, s + 1, s + 256), ''), '[ \t\n\x0B\f\r]+$', '')) AS text_md5
FROM w
""")
def e1_streaming_ingest(spark, sf):
    """Captured pages arrive as two file drops, the second with the other half of the
    pages and shorter captures of pages that are there; each is ingested with
    availableNow, then everything is replayed from a new stream checkpoint. Returns the
    live chunk rows: those of each page's newest capture."""
    import uuid

    from quill.streaming.ingest import ingest_pages, open_ingested

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/e1-{uuid.uuid4().hex}"
    pages, later = _captures(spark, sf)
    even = F.pmod("page_id", F.lit(2)) == 0
    pages.filter(even).write.parquet(f"{root}/pages/drop1")
    ingest_pages(spark, f"{root}/pages/*", f"{root}/store", "web", checkpoint=f"{root}/stream", buckets=8)
    pages.filter(~even).unionByName(later).write.parquet(f"{root}/pages/drop2")
    ingest_pages(spark, f"{root}/pages/*", f"{root}/store", "web", checkpoint=f"{root}/stream", buckets=8)
    ingest_pages(spark, f"{root}/pages/*", f"{root}/store", "web", checkpoint=f"{root}/stream-replay", buckets=8)
    store = open_ingested(spark, f"{root}/store", "web")
    return store.select("chunk_id", "ordinal", "module", F.size("embedding").alias("dim"), F.md5("text").alias("text_md5"))


def _written_stores(spark, sf, root):
    """Derived input: the vectors as store rows of ten modules, written as one store of all
    modules and as one store a module group at the default paths below ``root``."""
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("vec_id").alias("ordinal"), F.concat(F.lit("text "), "vec_id").alias("text"),
        F.create_map(F.lit("source"), F.concat(F.lit("doc-"), "vec_id")).alias("metadata"), "embedding",
        F.concat(F.lit("label-"), "label").alias("module"), "label")
    ST.write_store(rows, f"{root}/flat/all.parquet")
    for group in range(3):
        ST.write_store(rows.filter(F.pmod("label", F.lit(3)) == group), ST.default_store_path(f"{root}/docs", f"group-{group}"))


@register("s4_s5_store_roundtrip", sql="""
SELECT vec_id AS chunk_id, 'label-' || label AS module, 'text ' || vec_id AS text, 'doc-' || vec_id AS source,
       CAST(len(embedding) AS INTEGER) AS dim, round(list_sum(embedding::DOUBLE[]), 6) AS total
FROM embeddings WHERE label IN (2, 7)
""")
def s4_s5_store_roundtrip(spark, sf):
    """A store of all modules is written, opened, and two modules are selected;
    their folders only are read."""
    import uuid

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stores-{uuid.uuid4().hex}"
    _written_stores(spark, sf, root)
    store = ST.open_store(spark, f"{root}/flat/all.parquet")
    rows = S.select_module(store, "label-2").unionByName(ST.open_store(spark, f"{root}/flat/all.parquet", module="label-7"))
    return rows.select("chunk_id", "module", "text", F.col("metadata")["source"].alias("source"), F.size("embedding").alias("dim"),
                       F.round(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register("s6_a6_store_catalogue", sql="""
SELECT module, count(*) AS n_stores FROM (
  SELECT DISTINCT 'group-' || (label % 3) AS module FROM embeddings) GROUP BY ROLLUP (module)
""")
def s6_a6_store_catalogue(spark, sf):
    """The stores below a folder by listing, one of each module group and the total."""
    import uuid

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stores-{uuid.uuid4().hex}"
    _written_stores(spark, sf, root)
    return ST.list_stores(spark, f"{root}/docs")
