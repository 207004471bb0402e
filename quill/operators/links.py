"""Link graph: link extraction from pages and J8 bounded traversal.

Traversal is breadth first: each hop joins the frontier to the edge table,
removes nodes already visited (``left_anti``) and keeps each node once at its
minimum depth. The new nodes of a hop are written to the shared folder, which cuts
the lineage and lets a lost executor recompute only the last hop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.sources.tables import join_sized, sized, stored

HREF = r"""href\s*=\s*["']([^"'#]*)"""


def _normal(path: F.Column) -> F.Column:
    """An absolute path without ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, s: (
        F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(s)))))
    # a path that ends in a dot segment is a folder
    return F.concat(F.array_join(kept, "/"), F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit("")))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges ``src, dst`` from ``href`` attributes, resolved against the page URL
    (absolute URLs kept, ``/path`` joined to the host, other paths to the page's
    folder, ``?query`` to the page itself; ``.`` and ``..`` segments resolved)."""
    base = F.regexp_replace(F.col(url_col), r"[?#].*$", "")
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    folder = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    l = pages.select(F.col(url_col).alias("src"), base.alias("_b"), host.alias("_h"), folder.alias("_f"),
                     F.explode_outer(F.regexp_extract_all(F.col(html_col), F.lit(HREF), 1)).alias("_l"))
    l = l.filter(F.length("_l") > 0)   # on the generator output: not pushed below it
    path, query = F.regexp_replace("_l", r"(?s)\?.*$", ""), F.regexp_extract("_l", r"(?s)^[^?]*(\?.*)$", 1)
    dst = (F.when(F.col("_l").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("_l"))
           .when(F.col("_l").startswith("//"), F.concat(F.regexp_extract("src", r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.col("_l")))
           .when(F.col("_l").startswith("/"), F.concat("_h", _normal(path), query))
           .when(F.col("_l").startswith("?"), F.concat("_b", query))
           .otherwise(F.concat("_h", _normal(F.concat(F.col("_f"), path)), query)))
    return l.select("src", dst.alias("dst"))


def traverse(edges: DataFrame, seeds: DataFrame, max_depth: int, src_col: str = "src", dst_col: str = "dst",
             node_col: str = "node", same_host: bool = False, by: list[str] | None = None) -> DataFrame:
    """Nodes reachable from ``seeds`` (column ``node_col``) within
    ``max_depth`` hops, each with its minimum depth (seeds are depth 0). Stops
    early when the frontier is empty. ``by`` names columns of both tables that keep
    walks apart, such as a seed number: each is a traversal of its own, all in the same
    hops."""
    by = by or []
    e = edges.select(*by, F.col(src_col).alias("_s"), F.col(dst_col).alias(node_col))
    if same_host:
        h = lambda c: F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
        e = e.filter(h(F.col("_s")) == h(F.col(node_col)))
    key = [*by, node_col]
    # Every hop is written once, its new nodes only; what has been visited is read from all hops.
    frontier = stored(seeds.select(*key).distinct().withColumn("depth", F.lit(0)), "hop")
    visited = frontier
    for d in range(1, max_depth + 1):
        n, n_bytes = sized(frontier)
        if not n:
            break
        found = join_sized(e, frontier.withColumnRenamed(node_col, "_s").drop("depth"), [*by, "_s"], n_bytes).select(*key).distinct()
        frontier = stored(found.join(visited.select(*key), key, "left_anti").withColumn("depth", F.lit(d)), "hop")
        visited = visited.unionByName(frontier)
    return visited
