"""Line-ownership queries over blame lines derived from ``lineitem`` and an
author table derived from ``supplier``: P7, J2, F23, A5, W6, L1."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.operators import ownership as OW
from quill.operators.ordinal import global_index
from quill.plans.registry import register
from quill.sources.tables import table


def blame_lines(spark, sf):
    l = table(spark, sf, "lineitem")
    # a fifth more commits than suppliers: some lines have no known author
    n = table(spark, sf, "supplier").agg((F.count(F.lit(1)) * 6 / 5).cast("bigint") + 1).scalar()
    h = F.concat(F.lit("h"), F.lpad(F.pmod(F.col("l_orderkey"), n).cast("string"), 8, "0"))
    boundary = F.when(F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(11)) == 0, F.lit("^")).otherwise(F.lit(""))
    line = F.concat(boundary, h, F.lit(" (dev) line "), F.col("l_linenumber").cast("string"))
    return l.select(F.concat(F.lit("src/mod"), F.pmod("l_partkey", F.lit(20)).cast("string"), F.lit(".py")).alias("file"),
                    line.alias("line"))


def commit_authors(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.pmod("s_nationkey", F.lit(4))
    name = (F.when(k == 0, F.concat(F.col("s_name"), F.lit("(Aider)")))
            .when(k == 1, F.concat(F.col("s_name"), F.lit("  (aider)"))).otherwise(F.col("s_name")))
    return s.select(F.concat(F.lit("h"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("commit"),
                    name.alias("author"))


BLAME_SQL = r"""
bl AS (SELECT 'src/mod' || (l_partkey % 20) || '.py' AS file,
              CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN '^' ELSE '' END || 'h' || lpad(CAST(l_orderkey % (SELECT count(*) * 6 // 5 + 1 FROM supplier) AS VARCHAR), 8, '0')
              || ' (dev) line ' || l_linenumber AS line FROM lineitem),
au AS (SELECT 'h' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS commit,
              CASE s_nationkey % 4 WHEN 0 THEN s_name || '(Aider)' WHEN 1 THEN s_name || '  (aider)' ELSE s_name END AS author
       FROM supplier),
atr AS (SELECT bl.file, coalesce(au.author, 'Unknown') AS a0 FROM bl LEFT JOIN au ON substr(bl.line, 1, 9) = au.commit
       WHERE NOT starts_with(bl.line, '^')),
att AS (SELECT file, CASE WHEN contains(lower(a0), '(aider)') THEN regexp_replace(a0, '\s*\((?i)aider\)', ' (aider)', 'g') ELSE a0 END AS author FROM atr)
"""


@register("j2_p7_f23_attribution", sql=f"""
WITH {BLAME_SQL}
SELECT file, author, count(*) AS lines FROM att GROUP BY file, author
""")
def j2_p7_f23_attribution(spark, sf):
    return OW.attributed_counts(blame_lines(spark, sf), commit_authors(spark, sf))


@register("a5_w6_ownership", sql=f"""
WITH {BLAME_SQL},
g AS (SELECT file, author, count(*) AS lines FROM att GROUP BY file, author),
pa AS (SELECT author, sum(lines) AS lines FROM g GROUP BY author),
t AS (SELECT sum(lines) AS total FROM pa)
SELECT file, author, lines, CAST(NULL AS DOUBLE) AS percent FROM g
UNION ALL
SELECT NULL, author, CAST(lines AS BIGINT), round(lines * 100.0 / total, 2) FROM pa, t
""")
def a5_w6_ownership(spark, sf):
    return OW.ownership_counts(OW.attributed_counts(blame_lines(spark, sf), commit_authors(spark, sf)))


@register("a5_tag_share", sql=f"""
WITH {BLAME_SQL}
SELECT count(*) FILTER (WHERE contains(lower(author), '(aider)')) AS tag_lines, count(*) AS total_lines,
       CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE contains(lower(author), '(aider)')) * 100.0 / count(*), 2) ELSE 0.0 END AS tag_percent
FROM att
""")
def a5_tag_share(spark, sf):
    return OW.tag_share(OW.attributed_counts(blame_lines(spark, sf), commit_authors(spark, sf)))


@register("l1_authors_ranked", sql=f"""
WITH {BLAME_SQL},
pa AS (SELECT author, count(*) AS lines FROM att GROUP BY author)
SELECT author, lines, row_number() OVER (ORDER BY lines DESC, author) - 1 AS rank FROM pa
""")
def l1_authors_ranked(spark, sf):
    counts = OW.ownership_counts(OW.attributed_counts(blame_lines(spark, sf), commit_authors(spark, sf)))
    per = counts.filter(F.col("file").isNull()).select("author", "lines", (-F.col("lines")).alias("_neg"))
    return global_index(per, ["_neg", "author"], "rank").select("author", "lines", "rank")
