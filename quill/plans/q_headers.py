"""Header audit queries over rule files derived from ``documents``:
F6-F11, A3, A4, J7, P9 (P5 lives with the text queries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.operators import headers as H
from quill.plans.registry import register
from quill.sources.tables import table

# Derived input: header templates ("|" stands for a newline), folders and name
# suffixes, picked per document from its id.
TEMPLATES = [
    "---|description: |globs: |alwaysApply: true|---|",
    "---|description: Use when editing documents|globs: |alwaysApply: false|---|",
    "---|description: |globs: *.py, src/**/*.ts|alwaysApply: false|---|",
    "---|description: Rules for docs|globs: {docs/*.md,*.txt}|alwaysApply: false|---|",
    "---|description:|globs:|alwaysApply: false|---|",
    "---|description: Quoted globs|globs: \"*.py\", '*.md'||alwaysApply: false|---|",
    "---|description: Missing globs|alwaysApply: true|---|",
    "  |---|description: Leading blank|globs: *.md|alwaysApply: false|---|",
    "",
]
FOLDERS = ["core-rules/", "global-rules/", "tool-rules/", "py-rules/", "ui-rules/", "misc-rules/", ""]
NAME_SUFFIXES = ["-always", "-agent", "-auto", "-manual", ""]


def _pick(values, n):
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(F.col("doc_id"), F.lit(n)) + 1).cast("int"))


def rule_files(spark, sf):
    d = table(spark, sf, "documents")
    content = F.concat(F.replace(_pick(TEMPLATES, len(TEMPLATES)), F.lit("|"), F.lit("\n")), F.col("text"))
    path = F.concat(_pick(FOLDERS, len(FOLDERS)), F.lit("doc-"), F.col("doc_id").cast("string"),
                    _pick(NAME_SUFFIXES, len(NAME_SUFFIXES)), F.lit(".mdc"))
    return d.select("doc_id", path.alias("path"), content.alias("content"))


def _sql_list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def q(text):
    return "'" + text.replace("'", "''") + "'"


WS_TRIM = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _field_sql(name):
    rest = f"substr(block, strpos(block, '{name}:') + {len(name) + 1})"
    val = (f"CASE WHEN regexp_matches({rest}, '\\n[a-zA-Z][a-zA-Z0-9_]*:') "
           f"THEN regexp_extract({rest}, '(?s)^(.*?)\\n[a-zA-Z][a-zA-Z0-9_]*:', 1) ELSE {rest} END")
    return WS_TRIM.format(x=val)


FILES_SQL = f"""
f AS (SELECT doc_id,
        {_sql_list(FOLDERS)}[(doc_id % {len(FOLDERS)}) + 1] || 'doc-' || doc_id || {_sql_list(NAME_SUFFIXES)}[(doc_id % {len(NAME_SUFFIXES)}) + 1] || '.mdc' AS path,
        replace({_sql_list(TEMPLATES)}[(doc_id % {len(TEMPLATES)}) + 1], '|', chr(10)) || text AS content FROM documents),
h0 AS (SELECT *, starts_with({WS_TRIM.format(x='content')}, '---') AS opened,
              regexp_matches(content, '(?s)^---\\s*(.*?)\\s*---') AS m FROM f),
h1 AS (SELECT *, opened AND m AS closed,
              CASE WHEN opened AND m THEN regexp_extract(content, '(?s)^---\\s*(.*?)\\s*---', 1) END AS block FROM h0),
h2 AS (SELECT *, coalesce(closed AND contains(block, 'description:'), false) AS has_d,
              coalesce(closed AND contains(block, 'globs:'), false) AS has_g,
              coalesce(closed AND contains(block, 'alwaysApply:'), false) AS has_a FROM h1),
h3 AS (SELECT *, CASE WHEN has_d THEN {_field_sql('description')} ELSE '' END AS descr,
              CASE WHEN has_g THEN {_field_sql('globs')} ELSE '' END AS globs_raw,
              has_a AND lower({_field_sql('alwaysApply')}) = 'true' AS always FROM h2),
h AS (SELECT *, CASE WHEN has_a AND contains(globs_raw, 'alwaysApply:') THEN '' ELSE globs_raw END AS globs FROM h3),
t AS (SELECT *, CASE WHEN always THEN 'Always' WHEN descr <> '' AND globs = '' THEN 'Agent Selected'
                     WHEN descr = '' AND globs <> '' THEN 'Auto Select' WHEN descr <> '' AND globs <> '' THEN 'Auto Select+desc'
                     ELSE 'Manual' END AS rt FROM h)
"""

HEADER_ISSUES_SQL = f"""
  CASE WHEN NOT opened THEN {q(H.MISSING_OPEN)} END,
  CASE WHEN opened AND NOT closed THEN {q(H.MISSING_CLOSE)} END,
  CASE WHEN closed AND NOT has_d THEN 'Missing ''description'' field' END,
  CASE WHEN closed AND NOT has_g THEN 'Missing ''globs'' field' END,
  CASE WHEN has_g AND globs_raw <> '' AND (starts_with(globs_raw, '[') OR starts_with(globs_raw, '{{')) THEN {q(H.BAD_GLOB_FORMAT)} END,
  CASE WHEN has_g AND globs_raw <> '' AND contains(globs_raw, ',') AND NOT regexp_matches(globs_raw, ',\\s+') THEN {q(H.COMMA_SPACING)} END,
  CASE WHEN has_g AND starts_with(globs_raw, '"') AND suffix(globs_raw, '"') THEN {q(H.DOUBLE_QUOTED)}
       WHEN has_g AND starts_with(globs_raw, '''') AND suffix(globs_raw, '''') THEN {q(H.SINGLE_QUOTED)} END,
  CASE WHEN has_g AND regexp_matches(globs_raw, '["''][^,]*["'']') THEN {q(H.ITEM_QUOTED)} END,
  CASE WHEN closed AND NOT has_a THEN 'Missing ''alwaysApply'' field' END,
  CASE WHEN closed AND contains(block, chr(10) || chr(10)) THEN {q(H.EMPTY_LINES)} END"""

ALWAYS_ISSUES_SQL = f"""
  CASE WHEN closed AND always AND descr <> '' THEN {q(H.ALWAYS_DESC)} END,
  CASE WHEN closed AND always AND globs <> '' THEN {q(H.ALWAYS_GLOBS)} END"""


@register("f6_f7_f9_audit_headers", sql=f"""
WITH {FILES_SQL},
a AS (SELECT doc_id, path, CASE WHEN closed THEN rt ELSE 'Unknown' END AS rule_type,
             list_filter([{HEADER_ISSUES_SQL}, {ALWAYS_ISSUES_SQL}], lambda x: x IS NOT NULL) AS iss FROM t)
SELECT doc_id, path, rule_type, array_to_string(iss, ' | ') AS issues, CAST(len(iss) AS INTEGER) AS n_issues,
       len(iss) = 0 AS valid FROM a
""")
def f6_f7_f9_audit_headers(spark, sf):
    a = H.audit(rule_files(spark, sf))
    return a.select("doc_id", "path", "rule_type", F.array_join("issues", " | ").alias("issues"),
                    F.size("issues").alias("n_issues"), "valid")


@register("f6_header_fields", sql=f"""
WITH {FILES_SQL}
SELECT doc_id, opened, closed, descr AS description, globs, always AS always_apply FROM t
""")
def f6_header_fields(spark, sf):
    f = H.with_header(rule_files(spark, sf), "content", "h")
    return f.select("doc_id", *[F.col(f"h_{k}").alias(k) for k in ("opened", "closed", "description", "globs", "always_apply")])


SUFFIX_SQL = """
  CASE WHEN suffix(name, '-always.mdc') AND NOT always THEN 'File name indicates Always rule (-always.mdc) but alwaysApply is not true'
       WHEN suffix(name, '-agent.mdc') AND (descr = '' OR globs <> '') THEN 'File name indicates Agent Selected rule (-agent.mdc) but frontmatter doesn''t match'
       WHEN suffix(name, '-auto.mdc') AND globs = '' THEN 'File name indicates Auto Select rule (-auto.mdc) but globs field is empty'
       WHEN suffix(name, '-manual.mdc') AND (descr <> '' OR globs <> '' OR always) THEN 'File name indicates Manual rule (-manual.mdc) but frontmatter doesn''t match' END"""


@register("f8_f11_audit_with_names", sql=f"""
WITH {FILES_SQL},
n AS (SELECT *, string_split(path, '/')[-1] AS name FROM t),
s AS (SELECT *, CASE WHEN suffix(name, '-always.mdc') THEN 'Always' WHEN suffix(name, '-agent.mdc') THEN 'Agent Selected'
                     WHEN suffix(name, '-auto.mdc') THEN CASE WHEN descr <> '' AND globs <> '' THEN 'Auto Select+desc' ELSE 'Auto Select' END
                     WHEN suffix(name, '-manual.mdc') THEN 'Manual' END AS ftype,
             CASE rt WHEN 'Always' THEN '-always.mdc' WHEN 'Agent Selected' THEN '-agent.mdc' WHEN 'Manual' THEN '-manual.mdc'
                     ELSE '-auto.mdc' END AS expected FROM n),
a AS (SELECT doc_id, path, CASE WHEN closed THEN rt ELSE 'Unknown' END AS rule_type,
             list_filter([{HEADER_ISSUES_SQL},
               CASE WHEN closed THEN {SUFFIX_SQL} END,
               {ALWAYS_ISSUES_SQL},
               CASE WHEN closed AND ftype IS NOT NULL AND rt <> ftype THEN 'File suffix (-' || replace(lower(ftype), ' ', '-')
                    || '.mdc) doesn''t match the rule type determined from frontmatter (' || rt || ')' END,
               CASE WHEN closed AND NOT suffix(name, expected) THEN 'File name should end with ''' || expected || ''' for ' || rt || ' rule type' END
             ], lambda x: x IS NOT NULL) AS iss,
             CASE WHEN len(string_split(path, '/')) = 1 THEN 'Rule file should be in an organizational subfolder, not in the root'
                  WHEN string_split(path, '/')[1] NOT IN ('core-rules', 'global-rules', 'tool-rules', 'ts-rules', 'py-rules', 'ui-rules')
                  THEN 'File is in unexpected organizational folder: ' || string_split(path, '/')[1] END AS folder_issue FROM s)
SELECT doc_id, path, rule_type, array_to_string(iss, ' | ') AS issues, len(iss) = 0 AS valid, folder_issue FROM a
""")
def f8_f11_audit_with_names(spark, sf):
    a = H.audit_with_names(rule_files(spark, sf))
    return a.select("doc_id", "path", "rule_type", F.array_join("issues", " | ").alias("issues"), "valid",
                    H.folder_issue(F.col("path")).alias("folder_issue"))


@register("j7_missing_folders", sql="""
WITH f AS (SELECT ['core-rules/', 'global-rules/', 'tool-rules/', 'py-rules/', 'ui-rules/', 'misc-rules/', ''][(doc_id % 7) + 1]
                  || 'doc-' || doc_id || '.mdc' AS path FROM documents),
ex AS (SELECT DISTINCT string_split(path, '/')[1] AS folder FROM f WHERE len(string_split(path, '/')) > 1),
e AS (SELECT * FROM (VALUES ('core-rules', 0), ('global-rules', 1), ('tool-rules', 2), ('ts-rules', 3), ('py-rules', 4), ('ui-rules', 5)) t(folder, pos))
SELECT folder, CAST(pos AS INTEGER) AS pos, 'Missing recommended organizational folder: ' || folder AS issue
FROM e WHERE folder NOT IN (SELECT folder FROM ex)
""")
def j7_missing_folders(spark, sf):
    return H.missing_folders(rule_files(spark, sf).select("path"))


@register("a3_rule_type_histogram", sql=f"""
WITH {FILES_SQL},
a AS (SELECT CASE WHEN closed THEN rt ELSE 'Unknown' END AS rule_type FROM t),
ty AS (SELECT * FROM (VALUES ('Always', 0), ('Agent Selected', 1), ('Auto Select', 2), ('Auto Select+desc', 3), ('Manual', 4), ('Unknown', 5)) v(rule_type, type_pos))
SELECT a.rule_type, count(*) AS n_files, CAST(ty.type_pos AS INTEGER) AS type_pos FROM a JOIN ty USING (rule_type) GROUP BY a.rule_type, ty.type_pos
""")
def a3_rule_type_histogram(spark, sf):
    return H.type_histogram(H.audit(rule_files(spark, sf))).select("rule_type", "n_files", "type_pos")


@register("a4_issues_per_folder", sql=f"""
WITH {FILES_SQL},
a AS (SELECT path, list_filter([{HEADER_ISSUES_SQL}, {ALWAYS_ISSUES_SQL}], lambda x: x IS NOT NULL) AS iss FROM t)
SELECT CASE WHEN len(string_split(path, '/')) > 1 THEN string_split(path, '/')[1] ELSE '' END AS folder,
       count(*) AS n_files, count(*) FILTER (WHERE len(iss) > 0) AS n_invalid, CAST(sum(len(iss)) AS BIGINT) AS n_issues
FROM a GROUP BY 1
""")
def a4_issues_per_folder(spark, sf):
    a = H.audit(rule_files(spark, sf))
    parts = F.split("path", "/")
    folder = F.when(F.size(parts) > 1, F.element_at(parts, 1)).otherwise(F.lit(""))
    return a.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.size("issues") > 0).alias("n_invalid"),
        F.sum(F.size("issues")).cast("bigint").alias("n_issues"))


@register("a4_issue_rows", sql=f"""
WITH {FILES_SQL},
a AS (SELECT path, list_filter([{HEADER_ISSUES_SQL}, {ALWAYS_ISSUES_SQL}], lambda x: x IS NOT NULL) AS iss FROM t)
SELECT path, CAST(generate_subscripts(iss, 1) - 1 AS INTEGER) AS issue_pos, unnest(iss) AS issue FROM a
""")
def a4_issue_rows(spark, sf):
    return H.issue_rows(H.audit(rule_files(spark, sf)))


@register("p9_glob_predicates", sql=r"""
WITH g AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '*.py, *.md' WHEN 1 THEN '*.py,*.md' WHEN 2 THEN '["*.py"]'
                               WHEN 3 THEN '"src/' || p_type || '/*"' WHEN 4 THEN '''' || p_brand || '''' ELSE '{' || p_name || '}' END AS globs FROM part)
SELECT p_partkey, globs,
  globs <> '' AND (starts_with(globs, '[') OR starts_with(globs, '{')) AS bad_format,
  globs <> '' AND contains(globs, ',') AND NOT regexp_matches(globs, ',\s+') AS comma_spacing,
  starts_with(globs, '"') AND suffix(globs, '"') AS double_quoted,
  NOT (starts_with(globs, '"') AND suffix(globs, '"')) AND starts_with(globs, '''') AND suffix(globs, '''') AS single_quoted,
  regexp_matches(globs, '["''][^,]*["'']') AS item_quoted
FROM g
""")
def p9_glob_predicates(spark, sf):
    p = table(spark, sf, "part")
    k = F.pmod("p_partkey", F.lit(6))
    globs = (F.when(k == 0, F.lit("*.py, *.md")).when(k == 1, F.lit("*.py,*.md")).when(k == 2, F.lit('["*.py"]'))
             .when(k == 3, F.concat(F.lit('"src/'), F.col("p_type"), F.lit('/*"')))
             .when(k == 4, F.concat(F.lit("'"), F.col("p_brand"), F.lit("'")))
             .otherwise(F.concat(F.lit("{"), F.col("p_name"), F.lit("}"))))
    g = p.select("p_partkey", globs.alias("globs"))
    iss = H.glob_issues(F.col("globs"))
    return g.select("p_partkey", "globs", iss[0].isNotNull().alias("bad_format"),
                    iss[1].isNotNull().alias("comma_spacing"),
                    F.coalesce(iss[2] == H.DOUBLE_QUOTED, F.lit(False)).alias("double_quoted"),
                    F.coalesce(iss[2] == H.SINGLE_QUOTED, F.lit(False)).alias("single_quoted"),
                    iss[3].isNotNull().alias("item_quoted"))


@register("f10_strict_validate")
def f10_strict_validate(spark, sf):
    v = H.strict_validate(rule_files(spark, sf))
    return v.select("doc_id", "path", F.array_join("errors", " | ").alias("errors"), "valid")
