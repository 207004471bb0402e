"""Vector store: S4 write, S5 open, S6 catalogue.

Layout: a Parquet dataset partitioned by ``module`` with columns
``chunk_id, ordinal, text, metadata, embedding``. Reading one module prunes
to its folder; a search reads only ``chunk_id, ordinal, embedding``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORE_COLUMNS = ["chunk_id", "ordinal", "text", "metadata", "embedding", "module"]


def default_store_path(docs_root: str, module: str) -> str:
    return f"{docs_root.rstrip('/')}/{module}/vectorstore/{module}_vectorstore.parquet"


def write_store(chunks: DataFrame, path: str, mode: str = "overwrite", files_per_module: int | None = None) -> None:
    """S4. Rows are rebalanced by module: a large module is written by many tasks, a
    small one as one file, of about the session's advisory partition size (adaptive
    execution). ``files_per_module`` fixes the number of files of each instead."""
    missing = [c for c in STORE_COLUMNS if c not in chunks.columns]
    if missing:
        raise ValueError(f"store rows need columns {missing}")
    d = chunks.select(*STORE_COLUMNS)
    if files_per_module:
        d = d.repartition(files_per_module, "module", F.pmod(F.xxhash64("chunk_id"), F.lit(files_per_module)))
    else:
        d = d.hint("rebalance", "module")
    d.write.mode(mode).partitionBy("module").parquet(path)


def open_store(spark: SparkSession, path: str | None = None, module: str | None = None,
               store: DataFrame | None = None, docs_root: str | None = None) -> DataFrame:
    """A given store is returned unchanged; else read ``path`` (or the
    default path of ``module`` under ``docs_root``) and check the schema."""
    if store is not None:
        return store
    if path is None:
        if module is None or docs_root is None:
            raise ValueError("need a store, a path, or a module and docs root")
        path = default_store_path(docs_root, module)
    df = spark.read.parquet(path)
    missing = [c for c in ("chunk_id", "ordinal", "embedding") if c not in df.columns]
    if missing:
        raise ValueError(f"not a vector store, missing {missing}: {path}")
    if module is not None and "module" in df.columns:
        df = df.filter(F.col("module") == module)
    return df


def store_paths(spark: SparkSession, root: str) -> DataFrame:
    """``module, path`` of every store below ``root``; the module is the name
    of the store's grandparent folder. A store is a ``*.parquet`` path, either one
    file or a dataset folder of part files. Only the file listing is read, never
    file content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root).select("path"))
    p = F.regexp_replace("path", "^file:", "")
    store = F.regexp_extract(p, r"^(.*?\.parquet)(/|$)", 1)
    stores = files.select(store.alias("path")).distinct()
    return stores.select(F.element_at(F.split("path", "/"), -3).alias("module"), "path")


def list_stores(spark: SparkSession, root: str) -> DataFrame:
    """S6 + A6: ``module, n_stores``, plus the total (module null); the paths are
    rows of ``store_paths``."""
    return store_paths(spark, root).rollup("module").agg(F.count(F.lit(1)).alias("n_stores"))
