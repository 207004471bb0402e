"""Line ownership: P7 boundary lines, J2 author lookup, F23 tag normalisation,
A5 counts per (file, author) and per author, W6 share of total, L1 order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.sources.tables import stored

# Abbreviated hash length, the default author and the author tag.
HASH_LEN = 9
UNKNOWN_AUTHOR = "Unknown"
TAG = "aider"


def normalise_tag(author, tag: str = TAG) -> F.Column:
    """``\\s*(tag)`` -> `` (tag)``, case-insensitive, only for names holding the tag."""
    a = F.col(author) if isinstance(author, str) else author
    has = F.lower(a).contains(f"({tag})")
    return F.when(has, F.regexp_replace(a, rf"(?iU)\s*\({tag}\)", f" ({tag})")).otherwise(a)


def attribute_lines(lines: DataFrame, authors: DataFrame, line_col: str = "line",
                    hash_col: str = "commit", author_col: str = "author", tag: str = TAG) -> DataFrame:
    """P7 + J2 + F23: drop ``^`` boundary lines, look the abbreviated hash up in
    the commit -> author table (Unknown when absent), normalise tagged names.
    The author table is a regular join input: AQE broadcasts it when its
    measured size allows, otherwise it is shuffled."""
    kept = lines.filter(~F.col(line_col).startswith("^"))
    kept = kept.withColumn("_h", F.substring(F.col(line_col), 1, HASH_LEN))
    # one author per hash, so a repeated hash never multiplies lines
    a = authors.groupBy(F.col(hash_col).alias("_h")).agg(F.max(author_col).alias("_a"))
    j = kept.join(a, "_h", "left")
    return j.withColumn(author_col, normalise_tag(F.coalesce("_a", F.lit(UNKNOWN_AUTHOR)), tag)).drop("_h", "_a")


def attributed_counts(lines: DataFrame, authors: DataFrame, file_col: str = "file", line_col: str = "line",
                      hash_col: str = "commit", author_col: str = "author", tag: str = TAG) -> DataFrame:
    """Lines per (file, author) of ``attribute_lines``, stored. Lines are counted by file and
    hash before the author lookup, so one import commit's lines make one row per file."""
    short = F.substring(F.col(line_col), 1, HASH_LEN).alias(line_col)
    per_hash = (lines.filter(~F.col(line_col).startswith("^")).select(file_col, short)
                .groupBy(file_col, line_col).agg(F.count(F.lit(1)).alias("lines")))
    named = attribute_lines(per_hash, authors, line_col, hash_col, author_col, tag)
    return stored(named.groupBy(file_col, author_col).agg(F.sum("lines").alias("lines")), "ownership")


def ownership_counts(counts: DataFrame, file_col: str = "file", author_col: str = "author") -> DataFrame:
    """A5: lines per (file, author), as given, and per author; ``file`` is null on the
    per-author rows, which carry their share of all lines in percent (W6)."""
    per_author = counts.groupBy(author_col).agg(F.sum("lines").alias("lines"))
    # the grand total is a scalar subquery: one value, no join
    total = counts.agg(F.sum("lines")).scalar()
    pa = per_author.select(
        F.lit(None).cast("string").alias(file_col), author_col, "lines",
        F.round(F.try_divide(F.col("lines") * 100.0, total), 2).alias("percent"))
    return counts.select(file_col, author_col, "lines", F.lit(None).cast("double").alias("percent")).unionByName(pa)


def tag_share(counts: DataFrame, author_col: str = "author", tag: str = TAG) -> DataFrame:
    """A5: lines by tagged authors, all lines, and their share in percent (0 when no lines)."""
    tagged = F.lower(F.col(author_col)).contains(f"({tag})")
    a = counts.agg(F.coalesce(F.sum(F.when(tagged, F.col("lines"))), F.lit(0)).alias("tag_lines"), F.coalesce(F.sum("lines"), F.lit(0)).alias("total_lines"))
    return a.withColumn("tag_percent", F.when(F.col("total_lines") > 0, F.round(
        F.col("tag_lines") * 100.0 / F.col("total_lines"), 2)).otherwise(F.lit(0.0)))


def authors_ranked(counts: DataFrame, author_col: str = "author") -> DataFrame:
    """L1: authors by lines descending, ties by name."""
    return counts.filter(F.col("file").isNull()).orderBy(F.desc("lines"), F.asc(author_col))
