"""Index files: F18 line parse, F19 URL slug, S11 URL map, J5 coverage,
J6 description-only update, U3 union with one entry per URL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.functions.text import py_strip, url_slug

# The index line layout ``[title](url): description (summary)``.
INDEX_LINE = r"^\[([^\]]*)\]\(([^)\s]*)\):[ \t]*(.*?)[ \t]*\((.*)\)[ \t]*$"
DESCRIPTION_LEAD = "LLM should read this page when "


def parse_index_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """S10 + F18: one entry per non-blank line; lines that do not parse keep
    nulls in the fields and ``valid = false``."""
    ne = lines.filter(F.length(py_strip(F.col(line_col))) > 0)
    l = F.col(line_col)
    ok = l.rlike(INDEX_LINE)
    ext = lambda i: F.when(ok, F.regexp_extract(l, INDEX_LINE, i))
    return ne.select("*", ext(1).alias("title"), ext(2).alias("url"), ext(3).alias("description"),
                     ext(4).alias("summary"), ok.alias("valid"))


def render_index_line(title, url, description, summary) -> F.Column:
    return F.concat(F.lit("["), title, F.lit("]("), url, F.lit("): "), description, F.lit(" ("), summary, F.lit(")"))


def url_map_from_json(df: DataFrame, json_col: str = "value") -> DataFrame:
    """JSON objects ``{url: file}`` -> ``url, file`` rows."""
    m = F.from_json(F.col(json_col), "map<string,string>")
    return df.select(F.explode_outer(m).alias("url", "file")).filter(F.col("url").isNotNull())


def url_files(df: DataFrame, url_col: str = "url") -> DataFrame:
    """the summary file name of every URL."""
    return df.withColumn("file", url_slug(F.col(url_col)))


def coverage(index: DataFrame, url_map: DataFrame, url_col: str = "url") -> DataFrame:
    """Full outer join of index entries and URL-map entries on url with a
    status: both / index_only / map_only."""
    i = index.select(F.col(url_col).alias("_iu")).distinct()
    m = url_map.select(F.col(url_col).alias("_mu")).distinct()
    j = i.join(m, F.col("_iu") == F.col("_mu"), "full")
    return j.select(F.coalesce("_iu", "_mu").alias(url_col),
                    F.when(F.col("_iu").isNotNull() & F.col("_mu").isNotNull(), "both")
                    .when(F.col("_iu").isNotNull(), "index_only").otherwise("map_only").alias("status"))


def update_descriptions(index: DataFrame, new: DataFrame, url_col: str = "url") -> DataFrame:
    """Same entries, description replaced where a new one exists."""
    # one description per url: a repeated one never repeats an entry
    n = new.groupBy(F.col(url_col).alias("_nu")).agg(F.max("description").alias("_nd"))
    j = index.join(n, F.col(url_col) == F.col("_nu"), "left")
    return j.withColumn("description", F.coalesce("_nd", "description")).drop("_nu", "_nd")


def union_latest(old: DataFrame, new: DataFrame, url_col: str = "url", version_col: str = "version") -> DataFrame:
    """Union of entries, one per URL: the highest version wins. Partial
    aggregation (max of a struct) keeps one row per URL per partition before the
    shuffle."""
    u = old.unionByName(new)
    payload = [c for c in u.columns if c not in (url_col, version_col)]
    best = u.groupBy(url_col).agg(F.max(F.struct(version_col, *payload)).alias("_b"))
    return best.select(url_col, *[F.col("_b")[c].alias(c) for c in [version_col, *payload]])
