"""Table source: the parquet tables of a scale-factor folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.session import ensure_checkpoint_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Tables that feed per-row work (regex tokenizing, HTML and JSON parsing,
# Arrow-batched Python) and the key that spreads their rows when a scan is too
# narrow. Tiny dimension tables are never spread.
SPREAD_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id",
               "lineitem": "l_orderkey", "orders": "o_orderkey", "part": "p_partkey",
               "customer": "c_custkey", "events": "event_id", "embeddings": "vec_id"}


# Bytes of a stored table that is broadcast at most, and what a row takes besides its text.
SIDE_BYTES = 8 * 1024 * 1024
ROW_BYTES = 64


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition on ``key`` only when the scan yields fewer partitions than
    the cluster has cores (a few large files). Large inputs already scan in
    thousands of splits and are left alone: no extra shuffle at scale."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, F.col(key))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    key = SPREAD_KEYS.get(name)
    if key and key in df.columns:
        df = spread(df, key)
    return df


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the folder the executors share and read back: computed once,
    column by column, whatever is read of it later. The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> tuple[int, int]:
    """Rows of a stored table, and about the bytes they take in memory."""
    text = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(ROW_BYTES))
    n, total = df.agg(F.count(F.lit(1)), F.sum(text)).first()
    return n, total or 0


def join_sized(rows: DataFrame, side: DataFrame, on: list[str], n_bytes: int) -> DataFrame:
    """``rows`` joined to a stored table of ``n_bytes``. How much ``rows`` are (links taken from
    texts, built pages) Spark can only guess, often far too low, and would broadcast them: here
    only ``side`` is broadcast, if it is small, else both are shuffled."""
    if n_bytes <= SIDE_BYTES:
        return rows.join(F.broadcast(side), on)
    return rows.hint("merge").join(side, on)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
