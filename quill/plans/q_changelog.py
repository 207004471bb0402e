"""Change-log queries: commits derived from ``orders`` (S13, F16, F17, P6, J3,
A7), changelog files derived from ``orders`` (F22, W5, W7, J4, U2, L2, W4, J10,
F34, L3) and versions derived from ``part`` (F24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.operators import changelog as CL
from quill.operators.bundle import ordinal_per_group
from quill.operators.ordinal import global_index
from quill.plans.registry import register
from quill.sources.tables import table

TYPES8 = ["feat", "fix", "docs", "test", "ci", "chore", "security", "Refactor"]


def _pick(values, key, n):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(n)) + 1).cast("int"))


def derived_commits(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    scope = F.when(F.pmod(k, F.lit(4)) == 0, F.lit(None)).otherwise(F.lower("o_orderpriority"))
    subject = (F.when(F.pmod(k, F.lit(3)) == 0, F.concat(F.lit("api: handle order "), k.cast("string")))
               .when(F.pmod(k, F.lit(3)) == 1, F.concat(F.lit("update status "), F.col("o_orderstatus")))
               .otherwise(F.concat(F.lit("a very long component name for order "), F.col("o_custkey").cast("string"),
                                   F.lit(": tidy"))))
    header = F.concat(_pick(TYPES8, k, 8), F.when(scope.isNull(), F.lit("")).otherwise(F.concat(F.lit("("), scope, F.lit(")"))),
                      F.lit(": "), subject)
    body = F.when(F.pmod(k, F.lit(50)) == 0, F.concat(F.lit("BREAKING CHANGE: order "), k.cast("string"))).otherwise(F.lit(""))
    return o.select(F.concat(F.lit("c"), k.cast("string")).alias("commit"), header.alias("header"), body.alias("body"),
                    F.col("o_orderdate").alias("date"), (F.pmod(k, F.lit(11)) == 0).alias("is_merge"), "o_orderstatus")


COMMITS_SQL = """
o AS (SELECT o_orderkey AS k, * FROM orders),
cm AS (SELECT 'c' || k AS commit,
         ['feat','fix','docs','test','ci','chore','security','Refactor'][(k % 8) + 1]
         || CASE WHEN k % 4 = 0 THEN '' ELSE '(' || lower(o_orderpriority) || ')' END || ': '
         || CASE WHEN k % 3 = 0 THEN 'api: handle order ' || k WHEN k % 3 = 1 THEN 'update status ' || o_orderstatus
                 ELSE 'a very long component name for order ' || o_custkey || ': tidy' END AS header,
         CASE WHEN k % 50 = 0 THEN 'BREAKING CHANGE: order ' || k ELSE '' END AS body,
         o_orderdate AS date, k % 11 = 0 AS is_merge, o_orderstatus FROM o),
sel AS (SELECT * FROM cm WHERE NOT is_merge AND date >= TIMESTAMP '1995-01-01' AND date <= TIMESTAMP '1998-12-31'
        AND commit NOT IN (SELECT commit FROM cm WHERE o_orderstatus = 'F')),
pc AS (SELECT commit, body, lower(regexp_extract(header, '(?i)^([a-z]+)(?:\\(([a-z0-9/-]+)\\))?: (.+)$', 1)) AS ctype,
              nullif(regexp_extract(header, '(?i)^([a-z]+)(?:\\(([a-z0-9/-]+)\\))?: (.+)$', 2), '') AS scope,
              regexp_extract(header, '(?i)^([a-z]+)(?:\\(([a-z0-9/-]+)\\))?: (.+)$', 3) AS subject
       FROM sel WHERE regexp_matches(header, '(?i)^([a-z]+)(?:\\(([a-z0-9/-]+)\\))?: (.+)$')),
ty AS (SELECT * FROM (VALUES ('feat','Added'),('fix','Fixed'),('perf','Changed'),('docs','Changed'),('style','Changed'),
        ('refactor','Changed'),('build','Changed'),('ci','Changed'),('chore','Added'),('deprecate','Deprecated'),
        ('remove','Removed'),('security','Security')) t(ctype, section)),
"""

TITLE_SQL = ("array_to_string(list_transform(string_split({x}, ''), lambda c, i: CASE WHEN i = 1 OR NOT "
             "regexp_matches(string_split({x}, '')[i - 1], '^\\p{{L}}$') THEN upper(c) ELSE lower(c) END), '')")


def _entries_sql(exclude: str) -> str:
    before = "regexp_replace(split_part(subject, ':', 1), '^\\s+|\\s+$', '', 'g')"
    comp = (f"CASE WHEN scope IS NOT NULL THEN {TITLE_SQL.format(x='scope')} "
            f"WHEN contains(subject, ':') AND length({before}) < 30 THEN {TITLE_SQL.format(x=before)} END")
    return f"""
j AS (SELECT pc.*, ty.section, {comp} AS component, coalesce(regexp_matches(body, '(?i)BREAKING CHANGE:'), false) AS is_breaking
      FROM pc JOIN ty USING (ctype) WHERE ctype NOT IN ({exclude})),
e AS (SELECT commit, section, is_breaking,
        CASE WHEN coalesce(component, '') <> '' THEN '**' || component || '**: ' || subject ELSE subject END
        || CASE WHEN is_breaking THEN ' [BREAKING]' ELSE '' END AS entry FROM j)
"""


@register("f16_f17_commit_entries", sql=f"""
WITH {COMMITS_SQL} {_entries_sql("'test', 'ci'")}
SELECT commit, section, entry, is_breaking FROM e
""")
def f16_f17_commit_entries(spark, sf):
    c = derived_commits(spark, sf)
    main = c.filter(F.col("o_orderstatus") == "F")
    sel = CL.select_commits(c, main, since="1995-01-01", until="1998-12-31")
    return CL.parse_commits(sel).select("commit", "section", "entry", "is_breaking")


@register("a7_section_summary", sql=f"""
WITH {COMMITS_SQL} {_entries_sql("'test', 'ci'")}
SELECT section, count(*) AS n_entries, bool_or(is_breaking) AS any_breaking FROM e GROUP BY ROLLUP (section)
""")
def a7_section_summary(spark, sf):
    c = derived_commits(spark, sf)
    sel = CL.select_commits(c, c.filter(F.col("o_orderstatus") == "F"), since="1995-01-01", until="1998-12-31")
    return CL.section_summary(CL.parse_commits(sel))


@register("p6_j3_types_override", sql=f"""
WITH {COMMITS_SQL} {_entries_sql("''")}
SELECT commit, section FROM e WHERE commit IN (SELECT commit FROM j WHERE ctype IN ('fix', 'test', 'ci'))
""")
def p6_j3_types_override(spark, sf):
    c = derived_commits(spark, sf)
    sel = CL.select_commits(c, c.filter(F.col("o_orderstatus") == "F"), since="1995-01-01", until="1998-12-31")
    return CL.parse_commits(sel, types=["fix", "test", "ci"]).select("commit", "section")


def changelog_lines(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    ver = F.concat_ws(".", F.pmod(k, F.lit(3)).cast("string"), F.pmod(k, F.lit(13)).cast("string"),
                      F.pmod(k, F.lit(7)).cast("string"))
    kind = F.pmod(k, F.lit(10))
    line = (F.when(kind == 0, F.concat(F.lit("## ["), ver, F.lit("] - "), F.date_format("o_orderdate", "yyyy-MM-dd")))
            .when(kind == 1, F.lit("## [Unreleased]"))
            .when(kind == 2, F.concat(F.lit("### "), _pick(CL.SECTIONS, F.col("o_custkey") + k, 6)))
            .when(kind == 3, F.concat(F.lit("["), F.pmod(k, F.lit(3)).cast("string"), F.lit("."),
                                      F.pmod(k, F.lit(13)).cast("string"), F.lit(".0]: https://example.com/v"), k.cast("string")))
            .when(kind == 4, F.concat(F.lit("Intro text for "), F.col("o_custkey").cast("string")))
            .otherwise(F.when(F.pmod(k, F.lit(20)) == 5, F.lit("- Duplicate entry"))
                       .otherwise(F.concat(F.lit("- Entry "), k.cast("string"), F.lit(" "), F.col("o_orderpriority")))))
    return o.select(F.concat(F.lit("CHANGELOG-"), F.col("o_custkey").cast("string")).alias("file"),
                    k.alias("line_no"), line.alias("line"))


LINES_SQL = """
cl AS (SELECT 'CHANGELOG-' || o_custkey AS file, o_orderkey AS line_no,
  CASE o_orderkey % 10
    WHEN 0 THEN '## [' || (o_orderkey % 3) || '.' || (o_orderkey % 13) || '.' || (o_orderkey % 7) || '] - ' || strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN '## [Unreleased]'
    WHEN 2 THEN '### ' || ['Added', 'Changed', 'Deprecated', 'Removed', 'Fixed', 'Security'][((o_custkey + o_orderkey) % 6) + 1]
    WHEN 3 THEN '[' || (o_orderkey % 3) || '.' || (o_orderkey % 13) || '.0]: https://example.com/v' || o_orderkey
    WHEN 4 THEN 'Intro text for ' || o_custkey
    ELSE CASE WHEN o_orderkey % 20 = 5 THEN '- Duplicate entry' ELSE '- Entry ' || o_orderkey || ' ' || o_orderpriority END
  END AS line FROM orders),
k AS (SELECT *,
  CASE WHEN regexp_matches(line, '^## \\[([^\\]]+)\\](?: - (\\d{4}-\\d{2}-\\d{2}))?') THEN 'version'
       WHEN regexp_matches(line, '^### (Added|Changed|Deprecated|Removed|Fixed|Security)') THEN 'section'
       WHEN regexp_matches(line, '^\\[([^\\]]+)\\]: (.+)$') THEN 'link'
       WHEN regexp_matches(line, '^- (.+)$') THEN 'entry' ELSE 'other' END AS kind FROM cl)
"""


@register("f22_line_classes", sql=f"""
WITH {LINES_SQL}
SELECT file, line_no, kind,
  CASE WHEN kind = 'version' THEN nullif(regexp_extract(line, '^## \\[([^\\]]+)\\](?: - (\\d{{4}}-\\d{{2}}-\\d{{2}}))?', 1), '') END AS version,
  CASE WHEN kind = 'version' THEN nullif(regexp_extract(line, '^## \\[([^\\]]+)\\](?: - (\\d{{4}}-\\d{{2}}-\\d{{2}}))?', 2), '') END AS date,
  CASE WHEN kind = 'section' THEN substr(line, 5) END AS section,
  CASE WHEN kind = 'link' THEN regexp_extract(line, '^\\[([^\\]]+)\\]: (.+)$', 1) END AS link_version,
  CASE WHEN kind = 'link' THEN regexp_extract(line, '^\\[([^\\]]+)\\]: (.+)$', 2) END AS url
FROM k
""".replace("{{", "{").replace("}}", "}"))
def f22_line_classes(spark, sf):
    c = CL.classify_lines(changelog_lines(spark, sf))
    return c.select("file", "line_no", "kind", "version", "date", "section", "link_version", "url")


W5_SQL = f"""
WITH {LINES_SQL},
m AS (SELECT *, CASE WHEN kind = 'version' AND line LIKE '## [Unreleased]%' THEN true END AS u,
             CASE WHEN kind = 'version' THEN '' WHEN kind = 'section' THEN substr(line, 5) END AS sec FROM k),
f AS (SELECT *, last_value(u IGNORE NULLS) OVER w AS u_ff, last_value(sec IGNORE NULLS) OVER w AS sec_ff FROM m
      WINDOW w AS (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ue AS (SELECT file, line_no, sec_ff AS section, line AS entry FROM f
       WHERE kind = 'entry' AND coalesce(u_ff, false) AND coalesce(sec_ff, '') <> '')
"""


@register("w5_unreleased_entries", sql=W5_SQL + "SELECT * FROM ue")
def w5_unreleased_entries(spark, sf):
    return CL.unreleased_entries(changelog_lines(spark, sf))


@register("l2_sorted_entries", sql=W5_SQL + """
SELECT file, section, entry, row_number() OVER (PARTITION BY file, section ORDER BY lower(entry), line_no) AS ordinal FROM ue
""")
def l2_sorted_entries(spark, sf):
    e = CL.unreleased_entries(changelog_lines(spark, sf))
    # rank = position in the L2 order (file, section, lower(entry), line_no)
    e = e.withColumn("_g", F.concat_ws("\u0001", "file", "section")).withColumn("_o", F.struct(F.lower("entry"), "line_no"))
    return ordinal_per_group(e, "_g", "_o").select("file", "section", "entry", "ordinal")


@register("j4_u2_merge_entries", sql=W5_SQL + """,
ex AS (SELECT file, section, entry FROM ue),
nw AS (SELECT 'CHANGELOG-' || o_custkey AS file, 'Added' AS section,
              CASE WHEN o_orderkey % 20 = 5 THEN '- Duplicate entry' ELSE '- New ' || o_orderpriority END AS entry FROM orders),
al AS (SELECT * FROM ex UNION ALL SELECT * FROM nw WHERE (file, section, entry) NOT IN (SELECT (file, section, entry) FROM ex))
SELECT file, section, entry, count(*) AS n FROM al GROUP BY ALL
""")
def j4_u2_merge_entries(spark, sf):
    ex = CL.unreleased_entries(changelog_lines(spark, sf)).select("file", "section", "entry")
    o = table(spark, sf, "orders")
    nw = o.select(F.concat(F.lit("CHANGELOG-"), F.col("o_custkey").cast("string")).alias("file"),
                  F.lit("Added").alias("section"),
                  F.when(F.pmod("o_orderkey", F.lit(20)) == 5, F.lit("- Duplicate entry"))
                  .otherwise(F.concat(F.lit("- New "), F.col("o_orderpriority"))).alias("entry"))
    return CL.merge_entries(ex, nw).groupBy("file", "section", "entry").agg(F.count(F.lit(1)).alias("n"))


@register("w7_section_order", sql=f"""
WITH {LINES_SQL},
u AS (SELECT file, min(line_no) AS s FROM k WHERE kind = 'version' AND contains(line, '[Unreleased]') GROUP BY file),
n AS (SELECT k.file, min(k.line_no) AS e FROM k JOIN u USING (file) WHERE k.kind = 'version' AND NOT contains(k.line, '[Unreleased]') AND k.line_no > u.s GROUP BY k.file),
b AS (SELECT u.file, u.s, n.e FROM u LEFT JOIN n USING (file)),
sc AS (SELECT k.file, substr(k.line, 5) AS section, min(k.line_no) AS first FROM k JOIN b USING (file)
       WHERE k.kind = 'section' AND k.line_no > b.s AND (b.e IS NULL OR k.line_no < b.e) GROUP BY k.file, section),
fo AS (SELECT file, section, CAST(dense_rank() OVER (PARTITION BY file ORDER BY first) AS INTEGER) AS pos FROM sc),
fx AS (SELECT * FROM (VALUES ('Added', 1), ('Changed', 2), ('Deprecated', 3), ('Removed', 4), ('Fixed', 5), ('Security', 6)) t(section, pos))
SELECT * FROM fo
UNION ALL
SELECT f.file, fx.section, CAST(fx.pos AS INTEGER) FROM (SELECT DISTINCT file FROM cl WHERE file NOT IN (SELECT file FROM fo)) f, fx
""")
def w7_section_order(spark, sf):
    return CL.section_order(changelog_lines(spark, sf)).select("file", "section", "pos")


@register("w4_previous_version", sql=f"""
WITH {LINES_SQL},
v AS (SELECT DISTINCT file, regexp_extract(line, '^## \\[([^\\]]+)\\]', 1) AS version FROM k WHERE kind = 'version'
      AND regexp_extract(line, '^## \\[([^\\]]+)\\]', 1) <> 'Unreleased'),
p AS (SELECT *, string_split(version, '.') AS parts FROM v)
SELECT file, version, lag(version) OVER (PARTITION BY file ORDER BY CAST(parts[1] AS INTEGER), CAST(parts[2] AS INTEGER),
       CAST(parts[3] AS INTEGER), version) AS previous FROM p
""")
def w4_previous_version(spark, sf):
    c = CL.classify_lines(changelog_lines(spark, sf)).filter(F.col("kind") == "version")
    v = c.select("file", "version").distinct()
    return CL.previous_versions(v).select("file", "version", "previous")


def next_versions(classified):
    """Per file: the bump of its highest released version (0.0.0.dev0 when none)."""
    files = classified.select("file").distinct()
    key = CL.version_key(F.col("version"))
    top = (classified.filter((F.col("kind") == "version") & key.isNotNull())
           .groupBy("file").agg(F.max(F.struct(key.alias("key"), "version"))["version"].alias("_v")))
    # the version itself is bumped: a pre-release keeps its tag
    return files.join(top, "file", "left").select(
        "file", F.coalesce(CL.bump_version(F.col("_v")), F.lit("0.0.0.dev0")).alias("new_version"))


@register("j10_f34_l3_release_links", sql=f"""
WITH {LINES_SQL},
lk AS (SELECT file, max(regexp_extract(line, '^\\[([^\\]]+)\\]: (.+)$', 1)) FILTER (WHERE regexp_extract(line, '^\\[([^\\]]+)\\]: (.+)$', 1) <> 'Unreleased') AS prev
       FROM k WHERE kind = 'link' GROUP BY file),
fl AS (SELECT DISTINCT file FROM cl),
v AS (SELECT file, CAST(string_split(regexp_extract(line, '^## \\[([^\\]]+)\\]', 1), '.')[1] AS INTEGER) AS a,
             CAST(string_split(regexp_extract(line, '^## \\[([^\\]]+)\\]', 1), '.')[2] AS INTEGER) AS b,
             CAST(string_split(regexp_extract(line, '^## \\[([^\\]]+)\\]', 1), '.')[3] AS INTEGER) AS c
      FROM k WHERE kind = 'version' AND NOT contains(line, '[Unreleased]')),
top AS (SELECT file, max({{'a': a, 'b': b, 'c': c}}) AS t FROM v GROUP BY file),
nv AS (SELECT fl.file, coalesce(t.a, 0) || '.' || coalesce(t.b, 0) || '.' || (coalesce(t.c, -1) + 1) || '.dev0' AS new_version
       FROM fl LEFT JOIN (SELECT file, t.a AS a, t.b AS b, t.c AS c FROM top) t USING (file))
SELECT nv.file, nv.new_version, lk.prev AS previous,
  'https://example.com/project/compare/v' || nv.new_version || '...HEAD' AS unreleased_link,
  CASE WHEN lk.prev IS NOT NULL THEN 'https://example.com/project/compare/v' || lk.prev || '...v' || nv.new_version
       ELSE 'https://example.com/project/releases/tag/v' || nv.new_version END AS version_link
FROM nv LEFT JOIN lk USING (file)
""".replace("{{", "{").replace("}}", "}"))
def j10_f34_l3_release_links(spark, sf):
    """Finalising every file: the next version is the bump of its highest
    released version (0.0.0 when none); the previous link version is the
    reference's choice, the greatest link key in string order."""
    c = CL.classify_lines(changelog_lines(spark, sf))
    prev = (c.filter((F.col("kind") == "link") & (F.col("link_version") != "Unreleased"))
            .groupBy("file").agg(F.max("link_version").alias("previous")))
    j = next_versions(c).join(prev, "file", "left")
    unrel, link = CL.release_links(F.col("new_version"), F.col("previous"))
    return j.select("file", "new_version", "previous", unrel.alias("unreleased_link"), link.alias("version_link"))


@register("f24_version_bump", sql=r"""
WITH v AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN '00' || p_size ELSE '' || p_size END || '.' || (p_partkey % 10) || '.'
             || CASE p_partkey % 7 WHEN 0 THEN '9' || repeat('9', CAST(p_partkey % 23 AS INTEGER)) WHEN 1 THEN '12345678901234567890' || (p_partkey % 3)
                ELSE '' || (p_partkey % 3) END
             || CASE p_partkey % 4 WHEN 0 THEN '.dev' || (p_partkey % 5) WHEN 1 THEN '.rc' WHEN 2 THEN '.dev99999999999' || (p_partkey % 5) ELSE '' END AS version FROM part),
p AS (SELECT *, regexp_extract(version, '(?i)^(\d+)\.(\d+)\.(\d+)(\.[a-z]+)?(\d+)?$', ['a', 'b', 'c', 't', 'n']) AS m FROM v),
n AS (SELECT *, CAST(m.a AS HUGEINT) AS a, CAST(m.b AS HUGEINT) AS b, CAST(m.c AS HUGEINT) AS c,
             CASE WHEN m.t <> '' THEN coalesce(TRY_CAST(nullif(m.n, '') AS HUGEINT), 0) END AS n FROM p)
SELECT p_partkey, version, CAST(a AS VARCHAR) AS major, CAST(b AS VARCHAR) AS minor, CAST(c AS VARCHAR) AS patch, CAST(n AS VARCHAR) AS num,
  CASE WHEN n IS NOT NULL THEN a || '.' || b || '.' || c || m.t || (n + 1) ELSE a || '.' || b || '.' || (c + 1) || '.dev0' END AS bumped,
  row_number() OVER (ORDER BY a, b, c, coalesce(n, 100000000000000000000000000000), p_partkey) - 1 AS place
FROM n
""")
def f24_version_bump(spark, sf):
    """Versions of any size parsed, bumped and put in order."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    tag = (F.when(F.pmod(k, F.lit(4)) == 0, F.concat(F.lit(".dev"), s(F.pmod(k, F.lit(5)))))
           .when(F.pmod(k, F.lit(4)) == 1, F.lit(".rc"))
           .when(F.pmod(k, F.lit(4)) == 2, F.concat(F.lit(".dev99999999999"), s(F.pmod(k, F.lit(5))))).otherwise(F.lit("")))
    major = F.when(F.pmod(k, F.lit(11)) == 0, F.concat(F.lit("00"), s(F.col("p_size")))).otherwise(s(F.col("p_size")))
    patch = (F.when(F.pmod(k, F.lit(7)) == 0, F.expr("repeat('9', int(p_partkey % 23 + 1))"))
             .when(F.pmod(k, F.lit(7)) == 1, F.concat(F.lit("12345678901234567890"), s(F.pmod(k, F.lit(3))))).otherwise(s(F.pmod(k, F.lit(3)))))
    v = F.concat_ws(".", major, s(F.pmod(k, F.lit(10))), patch)
    d = p.select("p_partkey", F.concat(v, tag).alias("version"))
    d = d.withColumn("key", CL.version_key(F.col("version")))
    d = global_index(d, ["key", "p_partkey"], "place")
    pv = CL.parse_version(F.col("version"))
    return d.select("p_partkey", "version", pv["major"].alias("major"), pv["minor"].alias("minor"),
                    pv["patch"].alias("patch"), pv["num"].alias("num"), CL.bump_version(F.col("version")).alias("bumped"), "place")


def _f33_sql(release: bool = False) -> str:
    commits = COMMITS_SQL.replace(
        """sel AS (SELECT * FROM cm WHERE NOT is_merge AND date >= TIMESTAMP '1995-01-01' AND date <= TIMESTAMP '1998-12-31'
        AND commit NOT IN (SELECT commit FROM cm WHERE o_orderstatus = 'F')),""",
        "sel AS (SELECT * FROM cm WHERE NOT is_merge),")
    assert "sel AS (SELECT * FROM cm WHERE NOT is_merge)," in commits
    body = W5_SQL.split("WITH", 1)[1]
    return f"""
WITH {body}, {commits} {_entries_sql("'test', 'ci'")},
ne AS (SELECT 'CHANGELOG-' || o.o_custkey AS file, e.section, '- ' || e.entry AS entry, o.o_orderkey AS seq
       FROM e JOIN orders o ON e.commit = 'c' || o.o_orderkey),
ex AS (SELECT file, section, entry, 0 AS src, line_no AS pos FROM ue),
mg AS (SELECT * FROM ex UNION ALL
       SELECT file, section, entry, 1, seq FROM ne WHERE (file, section, entry) NOT IN (SELECT (file, section, entry) FROM ex)),
u AS (SELECT file, min(line_no) AS s FROM k WHERE kind = 'version' AND contains(line, '[Unreleased]') GROUP BY file),
n AS (SELECT k.file, min(k.line_no) AS e FROM k JOIN u USING (file) WHERE k.kind = 'version' AND NOT contains(k.line, '[Unreleased]') AND k.line_no > u.s GROUP BY k.file),
b AS (SELECT u.file, u.s, n.e FROM u LEFT JOIN n USING (file)),
sc AS (SELECT k.file, substr(k.line, 5) AS section, min(k.line_no) AS first FROM k JOIN b USING (file)
       WHERE k.kind = 'section' AND k.line_no > b.s AND (b.e IS NULL OR k.line_no < b.e) GROUP BY k.file, section),
fo AS (SELECT file, section, CAST(dense_rank() OVER (PARTITION BY file ORDER BY first) AS INTEGER) AS pos FROM sc),
fx AS (SELECT * FROM (VALUES ('Added', 1), ('Changed', 2), ('Deprecated', 3), ('Removed', 4), ('Fixed', 5), ('Security', 6)) t(section, pos)),
fl AS (SELECT DISTINCT file FROM cl),
so AS (SELECT * FROM fo UNION ALL
       SELECT f.file, fx.section, CAST(fx.pos AS INTEGER) FROM (SELECT file FROM fl WHERE file NOT IN (SELECT file FROM fo)) f, fx),
en AS (SELECT mg.*, so.pos AS spos FROM mg JOIN so USING (file, section)),
hd AS (SELECT DISTINCT file, section, spos FROM en),
fv AS (SELECT file, min(line_no) AS fv FROM k WHERE kind = 'version' GROUP BY file),
hl AS (SELECT k.file, k.line_no, k.line FROM k LEFT JOIN fv USING (file) WHERE (fv.fv IS NULL OR k.line_no < fv.fv) AND k.kind <> 'link'),
af AS (SELECT k.file, min(k.line_no) AS af FROM k JOIN u USING (file)
       WHERE k.kind = 'version' AND NOT contains(k.line, '[Unreleased]') AND k.line_no > u.s GROUP BY k.file),
fr AS (SELECT file, min(line_no) AS fr FROM k WHERE kind = 'version' AND NOT contains(line, '[Unreleased]') GROUP BY file),
st AS (SELECT fl.file, coalesce(af.af, fr.fr) AS st, af.af IS NOT NULL AS main FROM fl LEFT JOIN af USING (file) LEFT JOIN fr USING (file)),
{{KEPT}},
lk AS (SELECT file, regexp_extract(line, '^\\[([^\\]]+)\\]: (.+)$', 1) AS lv,
              arg_max(regexp_extract(line, '^\\[([^\\]]+)\\]: (.+)$', 2), line_no) AS url FROM k WHERE kind = 'link' GROUP BY file, lv),
{{LINKS}}
allr AS (
  SELECT file, 0 AS block, line_no AS k1, 0 AS k2, '' AS k3, 0 AS k4, 0 AS k5, line FROM hl
  UNION ALL SELECT file, 1, 0, 0, '', 0, 0, '' FROM fl
  UNION ALL SELECT file, 1, 1, 0, '', 0, 0, '## [Unreleased]' FROM fl
  UNION ALL SELECT file, 3, 0, 0, '', 0, 0, '' FROM fl
  UNION ALL SELECT file, 3, 1, 0, '', 0, 0, '' FROM fl
{{FIXED}}
  UNION ALL SELECT file, 2, spos, 0, '', 0, 0, '' FROM hd
  UNION ALL SELECT file, 2, spos, 1, '', 0, 0, '### ' || section FROM hd
  UNION ALL SELECT file, 2, spos, 2, lower(entry), src, pos, entry FROM en
  UNION ALL SELECT file, 4, line_no, 1, '', 0, 0, line FROM kp
  {{BLANKS}}
  UNION ALL SELECT file, 5, CASE WHEN lv = 'Unreleased' THEN 0 ELSE 1 END, 0, lv, 0, 0, '[' || lv || ']: ' || url FROM {{LK}})
SELECT file, CAST(block AS INTEGER) AS block, CAST(k1 AS BIGINT) AS k1, CAST(k2 AS INTEGER) AS k2, CAST(k3 AS VARCHAR) AS k3,
       CAST(k4 AS BIGINT) AS k4, CAST(k5 AS BIGINT) AS k5, line FROM allr
""".replace("{KEPT}", KEPT_RELEASE if release else KEPT_UPDATE).replace("{LINKS}", LINKS_RELEASE if release else "") \
        .replace("{FIXED}", FIXED_RELEASE if release else "").replace("{BLANKS}", BLANKS_RELEASE if release else BLANKS_UPDATE) \
        .replace("{LK}", "lk2" if release else "lk")


KEPT_UPDATE = """kp AS (SELECT k.file, k.line_no, k.line FROM k JOIN st USING (file) WHERE st.st IS NOT NULL AND k.line_no >= st.st
       AND NOT (st.main AND k.kind = 'version' AND contains(k.line, '[Unreleased]'))),
rb AS (SELECT k.file, k.line_no, k.kind, st.st, last_value(CASE WHEN kind IN ('version', 'section') THEN kind END IGNORE NULLS) OVER (
         PARTITION BY k.file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prevh
       FROM k JOIN st USING (file) WHERE NOT st.main AND k.line_no >= st.st)"""
KEPT_RELEASE = """rv AS (SELECT k.* FROM k JOIN fr USING (file) WHERE k.line_no >= fr.fr),
rh AS (SELECT *, last_value(CASE WHEN kind IN ('version', 'section') THEN kind END IGNORE NULLS) OVER (
         PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prevh FROM rv),
kp AS (SELECT file, line_no, line, kind FROM rh WHERE prevh = 'section')"""
LINKS_RELEASE = """vv AS (SELECT file, CAST(string_split(regexp_extract(line, '^## \\[([^\\]]+)\\]', 1), '.')[1] AS INTEGER) AS a,
             CAST(string_split(regexp_extract(line, '^## \\[([^\\]]+)\\]', 1), '.')[2] AS INTEGER) AS b,
             CAST(string_split(regexp_extract(line, '^## \\[([^\\]]+)\\]', 1), '.')[3] AS INTEGER) AS c
      FROM k WHERE kind = 'version' AND NOT contains(line, '[Unreleased]')),
tp AS (SELECT file, max({'a': a, 'b': b, 'c': c}) AS t FROM vv GROUP BY file),
nvv AS (SELECT fl.file, CASE WHEN tp.t IS NULL THEN '0.0.0.dev0' ELSE tp.t.a || '.' || tp.t.b || '.' || (tp.t.c + 1) || '.dev0' END AS nv
        FROM fl LEFT JOIN tp USING (file)),
pv AS (SELECT file, max(lv) AS prev FROM lk WHERE lv <> 'Unreleased' GROUP BY file),
ad AS (SELECT file, 'Unreleased' AS lv, 'https://example.com/project/compare/v' || nv || '...HEAD' AS url FROM nvv
       UNION ALL SELECT nvv.file, nv, CASE WHEN pv.prev IS NOT NULL THEN 'https://example.com/project/compare/v' || pv.prev || '...v' || nv
                                          ELSE 'https://example.com/project/releases/tag/v' || nv END FROM nvv LEFT JOIN pv USING (file)),
lk2 AS (SELECT * FROM lk WHERE (file, lv) NOT IN (SELECT (file, lv) FROM ad) UNION ALL SELECT * FROM ad),"""
FIXED_RELEASE = """  UNION ALL SELECT file, 1, 2, 0, '', 0, 0, '' FROM fl
  UNION ALL SELECT file, 1, 3, 0, '', 0, 0, '## [' || nv || '] - 2026-01-01' FROM nvv"""
BLANKS_UPDATE = "UNION ALL SELECT file, 4, line_no, 0, '', 0, 0, '' FROM rb WHERE kind = 'version' AND prevh = 'section'"
BLANKS_RELEASE = "UNION ALL SELECT file, 4, line_no, 0, '', 0, 0, '' FROM kp WHERE kind = 'version'"


@register("f33_changelog_render", sql=_f33_sql())
def f33_changelog_render(spark, sf):
    """Every derived changelog updated with the parsed commits of its customer's orders."""
    lines = changelog_lines(spark, sf)
    c = derived_commits(spark, sf)
    o = table(spark, sf, "orders").select(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("commit"),
                                          F.concat(F.lit("CHANGELOG-"), F.col("o_custkey").cast("string")).alias("file"),
                                          F.col("o_orderkey").alias("seq"))
    ents = CL.parse_commits(CL.select_commits(c)).join(o, "commit").select(
        "file", "section", F.concat(F.lit("- "), F.col("entry")).alias("entry"), "seq")
    return CL.render_update(lines, ents)


@register("f33_changelog_release", sql=_f33_sql(release=True))
def f33_changelog_release(spark, sf):
    """Every derived changelog finalised as its next version (date passed in)."""
    lines = changelog_lines(spark, sf)
    c = derived_commits(spark, sf)
    o = table(spark, sf, "orders").select(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("commit"),
                                          F.concat(F.lit("CHANGELOG-"), F.col("o_custkey").cast("string")).alias("file"),
                                          F.col("o_orderkey").alias("seq"))
    ents = CL.parse_commits(CL.select_commits(c)).join(o, "commit").select(
        "file", "section", F.concat(F.lit("- "), F.col("entry")).alias("entry"), "seq")
    return CL.render_update(lines, ents, new_versions=next_versions, today="2026-01-01")
