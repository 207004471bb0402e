"""Bundles: S7 (document bundle per module), S8 (multi-file bundle with a table
of contents), W3 (1-based ordinal per module) and the ordered text sink.

Ordinals come from keys, never from row arrival order, and are computed
without a window over a whole module (a hot module would land in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.functions.text import anchor, py_strip
from quill.operators.ordinal import attach, key_index

# The bundle layout.
RULE_DASH = "-" * 80
RULE_EQ = "=" * 80
UNKNOWN_SOURCE = "Unknown URL"
TOC_TITLE = "# Table of Contents\n"
TOC_END = "\n---\n"
FILE_END = "\n\n---\n\n"
PATH_PREFIX = ".ai/"


def ordinal_per_group(df: DataFrame, group_col: str, order_col: str, name: str = "ordinal") -> DataFrame:
    """1-based rank of ``order_col`` inside each group, from a global index
    minus the group's first index (a group-size independent plan)."""
    # Keys only: the rows themselves are moved once, by the last join.
    g = key_index(df.select(group_col, order_col), "_gi")
    firsts = g.groupBy(group_col).agg(F.min("_gi").alias("_g0")).withColumnRenamed(group_col, "_ixg")
    places = g.join(firsts, F.expr(f"`{group_col}` <=> _ixg")).select(group_col, order_col, (F.col("_gi") - F.col("_g0") + 1).alias(name))
    return attach(df, places, [group_col, order_col], name)


def render_documents(df: DataFrame, module_col: str = "module", order_col: str = "doc_id",
                     source_col: str = "source", text_col: str = "text") -> DataFrame:
    """S7 rows: ``module, ordinal, block`` where block is one document's part of
    ``<module>_docs.txt``."""
    o = ordinal_per_group(df, module_col, order_col)
    block = F.concat(F.lit("Document "), F.col("ordinal").cast("string"), F.lit(": "),
                     F.coalesce(F.col(source_col), F.lit(UNKNOWN_SOURCE)), F.lit("\n" + RULE_DASH + "\n"),
                     F.col(text_col), F.lit("\n\n" + RULE_EQ + "\n\n"))
    return o.select(module_col, "ordinal", block.alias("block"))


def write_ordered_text(df: DataFrame, path: str, partition_col: str, order_cols: list[str],
                       text_col: str, n_files: int | None = None) -> None:
    """Ordered text sink: range-partition on (partition_col, order) so one hot
    module is spread over many files; part files are in order by name, and
    concatenating them gives the rows in order, each followed by a newline."""
    keys = [partition_col, *order_cols]
    d = df.repartitionByRange(n_files, *keys) if n_files else df.repartitionByRange(*keys)
    # The text writer ends every row with a newline: a row's own trailing
    # newline is absorbed so blocks that end in one are written unchanged.
    value = F.regexp_replace(F.col(text_col), r"\n\z", "")
    (d.sortWithinPartitions(*keys).select(partition_col, value.alias("value"))
     .write.mode("overwrite").partitionBy(partition_col).text(path))


def toc_bundle(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Line rows ``(section, rank, line)`` of the bundle: contents list, then
    each file under a header, files sorted by path. Sorting the rows by
    (section, rank, sub) and joining with newlines gives the bundle text."""
    # Paths only are numbered; the texts are read and moved once, for the bodies.
    idx = key_index(files.select(path_col), "rank")
    a = anchor(F.col(path_col))
    row = lambda section, sub, line: F.struct(F.lit(section).alias("section"), F.lit(sub).alias("sub"), line.alias("line"))
    frame = idx.select("rank", F.inline(F.array(
        row(1, 0, F.concat(F.lit("- [" + PATH_PREFIX), F.col(path_col), F.lit("](#"), a, F.lit(")"))),
        row(2, 0, F.concat(F.lit("<h1 id='"), a, F.lit("'>" + PATH_PREFIX), F.col(path_col), F.lit("</h1>\n"))),
        row(2, 2, F.lit(FILE_END))))).select("section", "rank", "sub", "line")
    body = attach(files.select(path_col, text_col), idx, [path_col], "rank").select(
        F.lit(2).alias("section"), "rank", F.lit(1).alias("sub"), py_strip(F.col(text_col)).alias("line"))
    spark = files.sparkSession
    fixed = spark.createDataFrame([(0, 0, 0, TOC_TITLE), (1, 1 << 62, 0, TOC_END)],
                                  "section int, rank long, sub int, line string")
    return fixed.unionByName(frame).unionByName(body)


def plain_bundle(files: DataFrame, text_col: str = "text") -> DataFrame:
    """S8 plain variant: file contents each followed by a blank line, no order promised."""
    return files.select(F.concat(F.col(text_col), F.lit("\n\n")).alias("line"))
