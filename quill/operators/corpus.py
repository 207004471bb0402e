"""The build flow of a module's store, composed from the operators:

seeds (S2) -> captured pages reachable from each (S1 + J8 over page links,
only URLs under that seed, depth-bounded, U1) -> text (F1/F2) -> ordered bundle (S7,
W3) -> chunks (F4) -> embeddings (X1) -> Parquet store (S4), plus the token
counts per document and in total (A1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.functions.callables import Extractor, Length, measured
from quill.functions.text import count_tokens
from quill.operators.bundle import render_documents, write_ordered_text
from quill.operators.chunk import DEFAULT_CHUNK_SIZE, DEFAULT_OVERLAP, split_recursive
from quill.operators.embed import HashingEmbedder
from quill.operators.extract import DEFAULT_SELECTOR, html_to_text
from quill.operators.links import page_links, traverse
from quill.operators.ordinal import global_index
from quill.sources.pages import check_module, seed_table, url_ancestors
from quill.sources.store import default_store_path, write_store
from quill.sources.tables import join_sized, sized, stored

# Fixed value: crawl depth of a store build.
BUILD_DEPTH = 5


def crawl(pages: DataFrame, seeds: DataFrame, max_depth: int = BUILD_DEPTH) -> DataFrame:
    """Every seed's captured pages: those reachable from its URL by links, at most
    ``max_depth`` hops, never leaving that URL's own prefix. The columns of ``pages``
    with ``module``, ``seed_pos`` and ``depth``; a page under several seeds comes once for
    each, as the reference's loader runs once a seed (U1). Of seeds without these two
    columns, which can't be told apart, a page under several comes once."""
    by = [c for c in ("module", "seed_pos") if c in seeds.columns]
    bare = lambda c: F.regexp_replace(c, "#.*$", "")  # noqa: E731  a fragment names no other page
    edges = page_links(pages.withColumn("url", bare("url")))
    starts = stored(seeds.select(*by, bare("seed_url").alias("node")).distinct(), "seeds")
    above = edges.withColumn("_a", F.explode_outer(url_ancestors("dst"))).filter(F.col("_a").isNotNull())
    inside = join_sized(above, starts.withColumnRenamed("node", "_a"), ["_a"], sized(starts)[1]).select(*by, "src", "dst")
    # Read in every hop: links are taken from the pages once.
    reached = traverse(stored(inside.distinct(), "links"), starts, max_depth, by=by)
    return join_sized(pages.withColumn("node", bare("url")), reached, ["node"], sized(reached)[1]).select(*pages.columns, *by, "depth")


def build_store(spark: SparkSession, pages: DataFrame, module: str, docs_root: str,
                seeds: DataFrame | None = None, max_depth: int = BUILD_DEPTH, selector: str = DEFAULT_SELECTOR,
                size: int = DEFAULT_CHUNK_SIZE, overlap: int = DEFAULT_OVERLAP, embedder=None,
                bundle: bool = True, extractor: Extractor | None = None, length: Length | None = None) -> DataFrame:
    """Build ``module``'s store under ``docs_root``; returns token counts per
    document (``seed_pos, page_id``) plus the total (both null) before and after
    splitting. Documents are numbered in the order of seed and page; a chunk's id and
    ordinal are its document's number and its place there. ``extractor`` (X3) and
    ``length`` (X4, for splitting and counting) are the caller's own."""
    if seeds is None:
        check_module(module)
        seeds = seed_table(spark)
    seeds = seeds.filter(F.col("module") == module)
    count = (lambda c: measured(length, c)) if length else count_tokens
    found = global_index(crawl(pages, seeds, max_depth), ["seed_pos", "page_id"], "doc_id")
    docs = found.select("doc_id", "seed_pos", "page_id", F.col("url").alias("source"),
                        html_to_text(F.col("html"), selector, extractor).alias("text"), F.lit(module).alias("module"))
    # Texts are read by the bundle, the splitter and the counts: extracted once.
    docs = stored(docs, "docs")
    if bundle:
        write_ordered_text(render_documents(docs), f"{docs_root.rstrip('/')}/{module}/bundle",
                           "module", ["ordinal"], "block")
    chunks = split_recursive(docs, size=size, overlap=overlap, length=length)
    rows = chunks.select((F.col("doc_id") * 2147483648 + F.col("chunk_index")).alias("chunk_id"),
                         (F.col("doc_id") * 2147483648 + F.col("chunk_index")).alias("ordinal"), "text",
                         F.create_map(F.lit("source"), F.col("source")).alias("metadata"), "module",
                         "doc_id", "n_tokens")
    rows = (embedder or HashingEmbedder()).embed(rows)
    write_store(rows, default_store_path(docs_root, module))
    written = spark.read.parquet(default_store_path(docs_root, module))
    per_doc = docs.select("doc_id", "seed_pos", "page_id", count(F.col("text")).alias("doc_tokens"))
    per_chunk = (written.select(F.shiftright("chunk_id", 31).alias("doc_id"), count(F.col("text")).alias("t"))
                 .groupBy("doc_id").agg(F.sum("t").alias("chunk_tokens")))
    counts = per_doc.join(per_chunk, "doc_id", "left")
    both = F.struct("seed_pos", "page_id").alias("_d")
    return (counts.select(both, "doc_tokens", "chunk_tokens").rollup("_d").agg(F.sum("doc_tokens").alias("doc_tokens"), F.sum("chunk_tokens").alias("chunk_tokens"))
            .select("_d.seed_pos", "_d.page_id", "doc_tokens", "chunk_tokens"))
