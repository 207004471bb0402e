"""Connected components by alternating large-star and small-star rounds, each
one join and one grouped minimum; nothing reaches the driver but two sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) to ``node``, ``root``: the smallest node of its
    component, for every node that has an edge to another one. Self-loops,
    repeats and either direction are fine. Rounds go on until one changes nothing; their
    number grows with the logarithm of the longest path."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(small.select("e.*").filter("a <> b").distinct(), "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")),
                              F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return (now.unionAll(now.select("b", "b").distinct().toDF("a", "b"))
            .groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))
