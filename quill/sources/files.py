"""File sources: S3 whole-file text, S9 rule files, S10 index files, S12 Q/A
JSON, S15 text totals with UTF-8 checks, S8 plain bundle input.

Listing and reading go through Spark's file sources (``recursiveFileLookup``,
``pathGlobFilter``, ``_metadata``): one listing of a folder, read by many tasks, is
joined to the wanted names, so a missing file is a row and no path is asked for on
its own. Only a single named file is checked for on the Hadoop file system.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.functions.text import count_tokens


class ResourceError(ValueError):
    """Reading a module's full text failed (a ValueError, like the reference's)."""


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def module_docs_path(docs_root: str, module: str) -> str:
    return f"{docs_root.rstrip('/')}/{module}/{module}_docs.txt"


def read_module_docs(spark: SparkSession, docs_root: str, module: str) -> DataFrame:
    """S3: the whole ``<module>_docs.txt`` as one row ``module, path, text``.
    Any module name is accepted; a missing file raises the reference's error."""
    path = module_docs_path(docs_root, module)
    try:
        if not path_exists(spark, path):
            raise ValueError(f"Documentation file not found for module: {module}")
        df = spark.read.text(path, wholetext=True)
    except ValueError as e:
        raise ResourceError(f"Error reading documentation file: {e}") from e
    return df.select(F.lit(module).alias("module"), F.lit(path).alias("path"), F.col("value").alias("text"))


def _bare(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _path(col) -> F.Column:
    return F.regexp_replace(col, "^file:(//)?", "")


def read_all_module_docs(spark: SparkSession, docs_root: str, modules: DataFrame) -> DataFrame:
    """S3 for many modules: ``module, path, text, error`` for each row of ``modules``. One
    listing of ``<root>/*/*_docs.txt`` is joined to them; a module without its file has
    the reference's error and no text. No folder at all counts as no file."""
    root = _bare(docs_root).rstrip("/")
    want = modules.select("module").withColumn("path", F.concat(F.lit(root + "/"), "module", F.lit("/"), "module", F.lit("_docs.txt")))
    if path_exists(spark, docs_root):
        files = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*_docs.txt").text(docs_root, wholetext=True)
                 .select(_path(F.col("_metadata.file_path")).alias("_p"), F.col("value").alias("text")))
    else:
        files = spark.createDataFrame([], "_p string, text string")
    error = F.concat(F.lit("Error reading documentation file: Documentation file not found for module: "), "module")
    return want.join(files, want["path"] == files["_p"], "left").select("module", "path", "text", F.when(F.col("_p").isNull(), error).alias("error"))


RULE_GLOBS = {"audit": "{*.mdc,*.mdc.md}", "lines": "*.mdc", "strict": "{*.mdc,*.mdc.md}"}


def read_rule_files(spark: SparkSession, root: str, kind: str = "audit", recursive: bool = True) -> DataFrame:
    """Rule files below ``root`` as ``path`` (relative to root) and
    ``content``. ``kind``: audit (``.mdc`` and ``.mdc.md``, recursive), lines
    (``.mdc`` only), strict (flat listing)."""
    glob = RULE_GLOBS[kind]
    reader = (spark.read.option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true" if (recursive and kind != "strict") else "false"))
    df = reader.text(root, wholetext=True)
    full = _path(F.col("_metadata.file_path"))
    base = _bare(root).rstrip("/") + "/"
    rel = F.when(full.startswith(base), F.substring(full, len(base) + 1, 1 << 30)).otherwise(full)
    return df.select(rel.alias("path"), F.col("value").alias("content"))


def read_index_lines(spark: SparkSession, path: str) -> DataFrame:
    """Index files as lines with file and line number (parse with F18)."""
    df = spark.read.text(path)
    return df.select(_path(F.col("_metadata.file_path")).alias("file"),
                     F.col("value"))


def read_url_map(spark: SparkSession, path: str) -> DataFrame:
    """JSON object files ``{url: file}`` -> ``url, file``."""
    df = spark.read.text(path, wholetext=True)
    return (df.select(F.explode_outer(F.from_json("value", "map<string,string>")).alias("url", "file"))
            .filter(F.col("url").isNotNull()))


def read_qa(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of ``{question, answer}`` objects per file."""
    return spark.read.schema("question string, answer string").json(path, multiLine=True)


def text_totals(spark: SparkSession, paths: list[str] | DataFrame, texts: list[str] | None = None, root: str | None = None,
                missing: str = "raise") -> DataFrame:
    """S15 + A2 input: per file ``path, chars, tokens, error``. ``paths`` is a list, or a
    DataFrame with ``path`` and then ``root``, the folder below which they lie (of a
    list: its common folder). One listing of the root is joined to the paths; of a list
    only its files are opened. Totals are made where a file is read; the texts don't move.

    A file that is not valid UTF-8 has an error instead of totals, and so has a missing
    one; ``missing="raise"`` raises for the latter instead, as the reference aborts."""
    listed = not isinstance(paths, DataFrame)
    if listed and not paths and not texts:
        raise ValueError("Error: Must provide either --text or --files")
    parts = []
    if not listed or paths:
        if listed:
            names = sorted({_bare(p) for p in paths})
            root = root or (posixpath.dirname(names[0]) if len(names) == 1 else posixpath.commonpath(names))
            want = spark.createDataFrame([(p,) for p in paths], "_w string").select(F.col("_w").alias("path"), _path("_w").alias("_w"))
        else:
            want = paths.select("path", _path("path").alias("_w"))
        if root is None:
            raise ValueError("paths in a table need their root folder")
        if path_exists(spark, root):
            raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            name = _path(F.col("path"))
            raw = raw.filter(name.isin(names)) if listed else raw
            raw = raw.select(name.alias("_f"), F.col("content").cast("string").alias("_s"))
            ok = F.is_valid_utf8("_s")
            found = raw.select("_f", F.when(ok, F.length("_s")).alias("chars"), F.when(ok, count_tokens(F.col("_s"))).alias("tokens"), ok.alias("_ok"))
        else:
            found = spark.createDataFrame([], "_f string, chars int, tokens int, _ok boolean")
        out = want.join(found, want["_w"] == found["_f"], "left")
        if missing == "raise" and (lost := out.filter("_f is null").select("path").first()):
            raise FileNotFoundError(f"Error: File not found - {lost['path']}")
        error = (F.when(F.col("_f").isNull(), F.concat(F.lit("Error: File not found - "), "path"))
                 .when(~F.col("_ok"), F.concat(F.lit("Error: Could not decode "), "path", F.lit(" as UTF-8"))))
        parts.append(out.select("path", "chars", "tokens", error.alias("error")))
    if texts:
        t = spark.createDataFrame([(f"<text:{i}>", s) for i, s in enumerate(texts)], "path string, _s string")
        parts.append(t.select("path", F.length("_s").alias("chars"), count_tokens(F.col("_s")).alias("tokens"),
                              F.lit(None).cast("string").alias("error")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
