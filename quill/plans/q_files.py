"""File-source queries (S3, S9, S10, S12, S15): files derived from the given tables are
written below the shared folder, then listed and read by the library."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quill.operators.index import parse_index_lines
from quill.plans.q_index import INDEX_LINE_SQL, INDEX_SQL, derived_index
from quill.plans.q_text import TOKEN_SQL
from quill.plans.registry import register
from quill.session import ensure_checkpoint_dir
from quill.sources import files as FS
from quill.sources.tables import table

GROUPS = 24


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


def _write_files(spark, rows, root: str) -> None:
    """Each row's ``text`` as the file ``name`` below ``root``: a few files, written as one
    folder each and then given their names."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    rows.repartition("name").select("text", F.hex(F.col("name").cast("binary")).alias("h")).write.partitionBy("h").text(f"{root}-raw")
    top = fs_path(f"{root}-raw")
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(top):
        h = folder.getPath().getName()
        if h.startswith("h="):
            to = fs_path(f"{root}/{bytes.fromhex(h[2:]).decode()}")
            fs.mkdirs(to.getParent())
            fs.rename(next(f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")), to)


def _grouped(spark, sf, name):
    """Derived input: the documents joined into ``GROUPS`` texts with file names."""
    d = table(spark, sf, "documents").select("doc_id", "text", F.pmod("doc_id", F.lit(GROUPS)).cast("int").alias("g"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda r: r["text"]), "\n")
    return d.groupBy("g").agg(text.alias("text")).select(name(F.col("g").cast("string"), F.col("g")).alias("name"), "text", "g")


GROUPS_SQL = f"f AS (SELECT doc_id % {GROUPS} AS g, string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS text FROM documents GROUP BY g)"


@register("s3_module_docs", sql=f"""
WITH {GROUPS_SQL}, m AS (SELECT DISTINCT doc_id % {GROUPS} AS g, 'm' || (doc_id % {GROUPS}) AS module FROM documents)
SELECT module, md5(text) AS text_md5, CASE WHEN text IS NULL THEN
       'Error reading documentation file: Documentation file not found for module: ' || module END AS error
FROM m LEFT JOIN f ON f.g = m.g AND m.g % 5 <> 0
""")
def s3_module_docs(spark, sf):
    """S3: the full text of every module, an error for each without its file."""
    root = _folder(spark)
    rows = _grouped(spark, sf, lambda s, g: F.concat(F.lit("m"), s, F.lit("/m"), s, F.lit("_docs.txt")))
    _write_files(spark, rows.filter("g % 5 <> 0"), root)
    modules = table(spark, sf, "documents").select(F.concat(F.lit("m"), F.pmod("doc_id", F.lit(GROUPS)).cast("string")).alias("module")).distinct()
    return FS.read_all_module_docs(spark, root, modules).select("module", F.md5("text").alias("text_md5"), "error")


@register("s9_rule_files", sql=f"""
WITH {GROUPS_SQL}, n AS (SELECT *, CASE g % 3 WHEN 0 THEN '' WHEN 1 THEN 'core-rules/' ELSE 'core-rules/deep/' END || 'rule-' || g
  || CASE g % 4 WHEN 0 THEN '.mdc' WHEN 1 THEN '.mdc.md' WHEN 2 THEN '.md' ELSE '.mdc' END AS path FROM f)
SELECT kind, path, md5(text) AS text_md5 FROM n, (SELECT unnest(['audit', 'lines', 'strict']) AS kind)
WHERE CASE kind WHEN 'audit' THEN suffix(path, '.mdc') OR suffix(path, '.mdc.md') WHEN 'lines' THEN suffix(path, '.mdc')
      ELSE (suffix(path, '.mdc') OR suffix(path, '.mdc.md')) AND NOT contains(path, '/') END
""")
def s9_rule_files(spark, sf):
    """The rule files of a folder as the audit, the line check and the strict check list them."""
    root = _folder(spark)
    k = lambda g, n: F.pmod(g, F.lit(n))
    rows = _grouped(spark, sf, lambda s, g: F.concat(
        F.when(k(g, 3) == 0, "").when(k(g, 3) == 1, "core-rules/").otherwise("core-rules/deep/"), F.lit("rule-"), s,
        F.when(k(g, 4) == 1, ".mdc.md").when(k(g, 4) == 2, ".md").otherwise(".mdc")))
    _write_files(spark, rows, root)
    kinds = [FS.read_rule_files(spark, root, kind).select(F.lit(kind).alias("kind"), "path", F.md5("content").alias("text_md5")) for kind in FS.RULE_GLOBS]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@register("s10_index_files", sql=f"""
WITH {INDEX_SQL}
SELECT page_id % 8 AS file_no, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(value, {INDEX_LINE_SQL})) AS entries,
       count(DISTINCT regexp_extract(value, {INDEX_LINE_SQL}, 2)) FILTER (WHERE regexp_matches(value, {INDEX_LINE_SQL})) AS urls
FROM lines WHERE length(trim(value)) > 0 GROUP BY file_no
""")
def s10_index_files(spark, sf):
    """Index files of one entry a line, with blank lines between, read and parsed."""
    root = _folder(spark)
    lines = derived_index(spark, sf).withColumn("g", F.pmod("page_id", F.lit(8)))
    text = lines.groupBy("g").agg(F.array_join(F.array_sort(F.collect_list("value")), "\n\n").alias("text"))
    _write_files(spark, text.select(F.concat(F.lit("llms-"), F.col("g").cast("string"), F.lit(".txt")).alias("name"), "text"), root)
    parsed = parse_index_lines(FS.read_index_lines(spark, root))
    return (parsed.groupBy(F.regexp_extract("file", r"llms-(\d+)\.txt", 1).cast("bigint").alias("file_no"))
            .agg(F.count(F.lit(1)).alias("lines"), F.count("url").alias("entries"), F.countDistinct("url").alias("urls")))


@register("s12_question_files", sql="""
SELECT conv_id || ':' || turn AS question, text AS answer FROM conversations WHERE text IS NOT NULL
""")
def s12_question_files(spark, sf):
    """JSON arrays of question and answer objects over several lines, read as rows."""
    root = _folder(spark)
    c = table(spark, sf, "conversations").filter("text is not null").select(
        F.struct(F.concat_ws(":", "conv_id", "turn").alias("question"), F.col("text").alias("answer")).alias("o"), F.pmod("conv_id", F.lit(8)).alias("g"))
    text = c.groupBy("g").agg(F.to_json(F.collect_list("o"), {"pretty": "true"}).alias("text"))
    _write_files(spark, text.select(F.concat(F.lit("qa-"), F.col("g").cast("string"), F.lit(".json")).alias("name"), "text"), root)
    return FS.read_qa(spark, root)


@register("s15_text_totals", sql=f"""
WITH {GROUPS_SQL}, w AS (SELECT DISTINCT doc_id % {GROUPS} AS g FROM documents)
SELECT 'text-' || w.g || '.txt' AS name, CAST(CASE WHEN w.g % 4 <> 3 THEN length(f.text) END AS INTEGER) AS chars,
       CAST(CASE WHEN w.g % 4 <> 3 THEN len(regexp_extract_all(f.text, {TOKEN_SQL})) END AS INTEGER) AS tokens,
       CASE WHEN f.g IS NULL THEN 'missing' WHEN w.g % 4 = 3 THEN 'undecodable' END AS problem
FROM w LEFT JOIN f ON f.g = w.g AND w.g % 5 <> 0
""")
def s15_text_totals(spark, sf):
    """Totals of files by name; some aren't there, some aren't UTF-8."""
    root = _folder(spark)
    rows = _grouped(spark, sf, lambda s, g: F.concat(F.lit("text-"), s, F.lit(".txt"))).filter("g % 5 <> 0")
    # a lone lead byte at the end: the text writer puts the bytes of a string as they are
    broken = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("C3"))).cast("string")
    _write_files(spark, rows.withColumn("text", F.when(F.pmod("g", F.lit(4)) == 3, broken).otherwise(F.col("text"))), root)
    want = table(spark, sf, "documents").select(F.concat(F.lit(f"{root}/text-"), F.pmod("doc_id", F.lit(GROUPS)).cast("string"), F.lit(".txt")).alias("path")).distinct()
    got = FS.text_totals(spark, want, root=root, missing="rows")
    problem = F.when(F.col("error").startswith("Error: File not found"), "missing").when(F.col("error").startswith("Error: Could not decode"), "undecodable")
    return got.select(F.element_at(F.split("path", "/"), -1).alias("name"), "chars", "tokens", problem.alias("problem"))
