"""Index, URL-map, seed and link queries: S1-S2, U1, S10-S11, F18-F19, J5-J6, U3, J8."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.functions.text import url_slug
from quill.operators import index as IX
from quill.operators import links as LK
from quill.plans.registry import register
from quill.sources import pages as PG
from quill.sources.tables import table

SCHEME_HOST = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def derived_seeds(spark, sf):
    """Seeds derived from the captured pages: every host root and every
    first-level folder, module = host name. The two overlap on purpose."""
    p = table(spark, sf, "pages")
    base = F.regexp_replace("url", r"[?#].*$", "")
    root = F.regexp_extract(base, SCHEME_HOST, 1)
    host = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    first = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)
    roots = p.select(host.alias("module"), F.concat(root, F.lit("/")).alias("seed_url"))
    dirs = p.filter(first != "").select(host.alias("module"), F.concat(root, F.lit("/"), first, F.lit("/")).alias("seed_url"))
    return roots.unionByName(dirs).distinct()


SEEDS_SQL = r"""
b AS (SELECT url, regexp_replace(url, '[?#].*$', '') AS base FROM pages),
seeds AS (
  SELECT DISTINCT regexp_extract(base, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS module,
         regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/' AS seed_url FROM b
  UNION
  SELECT DISTINCT regexp_extract(base, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1),
         regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/' ||
         regexp_extract(base, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/', 1) || '/'
  FROM b WHERE regexp_extract(base, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/', 1) <> '')
"""


@register("u1_s1_pages_by_seed", sql=f"""
WITH {SEEDS_SQL}
SELECT s.module, s.seed_url, p.page_id FROM pages p JOIN seeds s ON starts_with(p.url, s.seed_url)
""")
def u1_s1_pages_by_seed(spark, sf):
    out = PG.load_pages(table(spark, sf, "pages").select("page_id", "url"), derived_seeds(spark, sf))
    return out.select("module", "seed_url", "page_id")


# The distinct seed URLs in the order of their first appearance.
SEED_URLS = list(dict.fromkeys(u for urls in PG.MODULE_URLS.values() for u in urls))


def seeded_pages(spark, sf):
    """Derived input: every captured page moved below one of the fixed seeds, by its number."""
    n = F.pmod("page_id", F.lit(len(SEED_URLS))).cast("int")
    seed = F.element_at(F.array(*map(F.lit, SEED_URLS)), n + 1)
    tail = F.concat(F.when(seed.endswith("/"), F.lit("p")).otherwise(F.lit("?p=")), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select("page_id", F.concat(seed, tail).alias("url"))


@register("s2_seed_dimension", sql=f"""
WITH s AS (SELECT * FROM (VALUES {", ".join(f"('{m}', {i}, '{u}')" for m, urls in PG.MODULE_URLS.items() for i, u in enumerate(urls))}) t(module, seed_pos, seed_url)),
u AS (SELECT page_id, {SEED_URLS!r}[(page_id % {len(SEED_URLS)}) + 1] AS seed FROM pages),
p AS (SELECT page_id, seed || CASE WHEN suffix(seed, '/') THEN 'p' ELSE '?p=' END || page_id AS url FROM u),
b AS (SELECT *, regexp_replace(url, '[?#].*$', '') AS base FROM p)
SELECT module, CAST(seed_pos AS INTEGER) AS seed_pos, seed_url, count(page_id) AS n_pages
FROM s LEFT JOIN b ON seed_url = url OR seed_url = base OR (suffix(seed_url, '/') AND starts_with(base, seed_url)) GROUP BY ALL
""")
def s2_seed_dimension(spark, sf):
    """The fixed seed table with the number of captured pages under each seed."""
    seeds = PG.seed_table(spark)
    under = PG.pages_for_seeds(seeded_pages(spark, sf), seeds).groupBy("module", "seed_pos").agg(F.count(F.lit(1)).alias("n_pages"))
    return seeds.join(under, ["module", "seed_pos"], "left").select("module", "seed_pos", "seed_url", F.coalesce("n_pages", F.lit(0)).alias("n_pages"))


def derived_index(spark, sf):
    p = table(spark, sf, "pages")
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    desc = F.concat(F.lit(IX.DESCRIPTION_LEAD + "looking for page "), F.col("page_id").cast("string"), F.lit("."))
    line = IX.render_index_line(title, F.col("url"), desc, title)
    # blank lines sit after pages whose URL ends in a slash
    return p.select("page_id", F.explode(F.when(F.col("url").endswith("/"), F.array(line, F.lit("  ")))
                                         .otherwise(F.array(line))).alias("value"))


INDEX_SQL = r"""
ix AS (SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages),
lines AS (SELECT page_id, '[' || title || '](' || url || '): LLM should read this page when looking for page ' || page_id || '. (' || title || ')' AS value FROM ix
          UNION ALL SELECT page_id, '  ' FROM ix WHERE suffix(url, '/'))
"""
INDEX_LINE_SQL = r"'^\[([^\]]*)\]\(([^)\s]*)\):[ \t]*(.*?)[ \t]*\((.*)\)[ \t]*$'"


@register("f18_s10_index_parse", sql=f"""
WITH {INDEX_SQL}
SELECT page_id, regexp_extract(value, {INDEX_LINE_SQL}, 1) AS title, regexp_extract(value, {INDEX_LINE_SQL}, 2) AS url,
       regexp_extract(value, {INDEX_LINE_SQL}, 3) AS description, regexp_extract(value, {INDEX_LINE_SQL}, 4) AS summary,
       regexp_matches(value, {INDEX_LINE_SQL}) AS valid
FROM lines WHERE length(trim(value)) > 0
""")
def f18_s10_index_parse(spark, sf):
    parsed = IX.parse_index_lines(derived_index(spark, sf))
    return parsed.select("page_id", "title", "url", "description", "summary", "valid")


@register("f19_url_slug", sql=r"""
SELECT page_id, url, replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '/', '_') || '.txt' AS file FROM pages
""")
def f19_url_slug(spark, sf):
    return IX.url_files(table(spark, sf, "pages").select("page_id", "url"))


@register("s11_url_map", sql=r"""
SELECT url, replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '/', '_') || '.txt' AS file FROM pages
""")
def s11_url_map(spark, sf):
    p = table(spark, sf, "pages")
    docs = p.select(F.to_json(F.create_map(F.col("url"), url_slug(F.col("url")))).alias("value"))
    return IX.url_map_from_json(docs)


@register("j5_index_coverage", sql=r"""
WITH i AS (SELECT DISTINCT url FROM pages WHERE NOT contains(url, '#')),
m AS (SELECT DISTINCT url FROM pages WHERE NOT contains(url, '?'))
SELECT coalesce(i.url, m.url) AS url,
       CASE WHEN i.url IS NOT NULL AND m.url IS NOT NULL THEN 'both' WHEN i.url IS NOT NULL THEN 'index_only' ELSE 'map_only' END AS status
FROM i FULL OUTER JOIN m ON i.url = m.url
""")
def j5_index_coverage(spark, sf):
    p = table(spark, sf, "pages").select("url")
    return IX.coverage(p.filter(~F.col("url").contains("#")), p.filter(~F.col("url").contains("?")))


@register("j6_update_descriptions", sql=r"""
SELECT url, CASE WHEN contains(url, '?') THEN 'LLM should read this page when following query ' || regexp_extract(url, '\?(.*)$', 1)
                 ELSE 'LLM should read this page when looking for page ' || page_id || '.' END AS description
FROM pages
""")
def j6_update_descriptions(spark, sf):
    p = table(spark, sf, "pages")
    old = p.select("url", F.concat(F.lit(IX.DESCRIPTION_LEAD + "looking for page "), F.col("page_id").cast("string"),
                                   F.lit(".")).alias("description"))
    new = p.filter(F.col("url").contains("?")).select(
        "url", F.concat(F.lit(IX.DESCRIPTION_LEAD + "following query "),
                        F.regexp_extract("url", r"\?(.*)$", 1)).alias("description"))
    return IX.update_descriptions(old, new).select("url", "description")


@register("u3_union_latest", sql=r"""
WITH u AS (SELECT url, 1 AS version, 'v1 ' || page_id AS summary FROM pages
           UNION ALL SELECT url, 2, 'v2 ' || page_id FROM pages WHERE contains(url, '#')),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY version DESC, summary DESC) AS rn FROM u)
SELECT url, version, summary FROM r WHERE rn = 1
""")
def u3_union_latest(spark, sf):
    p = table(spark, sf, "pages")
    old = p.select("url", F.lit(1).alias("version"), F.concat(F.lit("v1 "), F.col("page_id").cast("string")).alias("summary"))
    new = p.filter(F.col("url").contains("#")).select(
        "url", F.lit(2).alias("version"), F.concat(F.lit("v2 "), F.col("page_id").cast("string")).alias("summary"))
    return IX.union_latest(old, new)


@register("j8_link_traversal", sql="""
WITH RECURSIVE e AS (
  SELECT DISTINCT src, dst FROM (SELECT p_partkey AS src, (p_partkey * 2) % (SELECT count(*) FROM part) AS dst FROM part
                                 UNION ALL SELECT p_partkey, (p_partkey * 2 + 1) % (SELECT count(*) FROM part) FROM part)),
walk(node, depth) AS (
  SELECT p_partkey, 0 FROM part WHERE p_size <= 2
  UNION
  SELECT e.dst, w.depth + 1 FROM walk w JOIN e ON e.src = w.node WHERE w.depth < 5)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY node
""")
def j8_link_traversal(spark, sf):
    p = table(spark, sf, "part")
    n = p.agg(F.count(F.lit(1))).scalar()   # every part can be reached
    e = p.select(F.col("p_partkey").alias("src"), F.pmod(F.col("p_partkey") * 2, n).alias("dst")).unionByName(
        p.select(F.col("p_partkey").alias("src"), F.pmod(F.col("p_partkey") * 2 + 1, n).alias("dst")))
    seeds = p.filter(F.col("p_size") <= 2).select(F.col("p_partkey").alias("node"))
    return LK.traverse(e, seeds, max_depth=5).select("node", "depth")


@register("j8_page_links", sql=r"""
WITH l AS (SELECT url AS src, regexp_replace(url, '[?#].*$', '') AS base,
                  unnest(regexp_extract_all(html, 'href\s*=\s*["'']([^"''#]*)', 1)) AS l FROM pages)
SELECT src, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN l
                 WHEN starts_with(l, '//') THEN regexp_extract(src, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) || l
                 WHEN starts_with(l, '/') THEN regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1) || l
                 ELSE regexp_extract(base, '^(.*/)', 1) || l END AS dst
FROM l WHERE length(l) > 0
""")
def j8_page_links(spark, sf):
    return LK.page_links(table(spark, sf, "pages"))


def linked_pages(spark, sf):
    """Derived input: captured pages of three folders and an index page; each part is a page
    that links to three pages of about twice its number."""
    p = table(spark, sf, "part").select((F.col("p_partkey") + 1).alias("k"))
    n = p.agg(F.max("k").alias("n"))  # links wrap at the last part
    path = lambda k: (F.when(k == 1, F.lit("/")).when(k <= 4, F.concat(F.lit("/d"), F.pmod(k, F.lit(3)).cast("string"), F.lit("/")))
                      .otherwise(F.concat(F.lit("/d"), F.pmod(k, F.lit(3)).cast("string"), F.lit("/p"), k.cast("string"))))
    last = n.first()["n"]
    to = [F.pmod(F.col("k") * 2 + i, F.lit(last)) + 1 for i in (0, 1, 6)]
    links = F.concat(*[F.concat(F.lit('<a href="'), path(k), F.lit('">x</a>')) for k in to])
    pages = p.select(F.col("k").alias("page_id"), F.concat(F.lit("https://site.example"), path(F.col("k"))).alias("url"),
                     F.concat(F.lit("<article>"), links, F.lit("</article>")).alias("html"))
    seeds = spark.createDataFrame([("all", 0, "https://site.example/"), ("all", 1, "https://site.example/d0/"), ("some", 0, "https://site.example/d2/")],
                                  "module string, seed_pos int, seed_url string")
    return pages, seeds


@register("u1_j8_crawl_by_seed", sql="""
WITH RECURSIVE p AS (SELECT p_partkey + 1 AS k FROM part), m AS (SELECT max(k) AS n FROM p),
g AS (SELECT k, CASE WHEN k = 1 THEN '/' WHEN k <= 4 THEN '/d' || (k % 3) || '/' ELSE '/d' || (k % 3) || '/p' || k END AS path FROM p),
e AS (SELECT k AS src, unnest([(k * 2) % n + 1, (k * 2 + 1) % n + 1, (k * 2 + 6) % n + 1]) AS dst FROM p, m),
s AS (SELECT * FROM (VALUES ('all', 0, '/'), ('all', 1, '/d0/'), ('some', 0, '/d2/')) t(module, seed_pos, prefix)),
w AS (
  SELECT s.module, s.seed_pos, s.prefix, g.k, 0 AS depth FROM s JOIN g ON g.path = s.prefix
  UNION
  SELECT w.module, w.seed_pos, w.prefix, g.k, w.depth + 1 FROM w JOIN e ON e.src = w.k JOIN g ON g.k = e.dst AND starts_with(g.path, w.prefix) WHERE w.depth < 5)
SELECT module, seed_pos, k AS page_id, min(depth) AS depth FROM w GROUP BY module, seed_pos, k
""")
def u1_j8_crawl_by_seed(spark, sf):
    """Every seed's pages by links below its own URL, overlapping seeds repeating pages."""
    from quill.operators.corpus import crawl

    pages, seeds = linked_pages(spark, sf)
    return crawl(pages, seeds).select("module", "seed_pos", "page_id", "depth")
