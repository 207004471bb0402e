"""Incremental ingest of page files into a versioned store.

A Structured Streaming file source picks up new page files (Parquet with
``page_id, url, html``); every micro-batch runs F1 -> F5 -> embedding for the pages whose
capture is newer than the stored one and swaps their chunks in at once
(``quill.sources.versions``): a re-captured page leaves no old chunk behind, and a replayed
or late file changes nothing. ``availableNow`` processes what is there and stops; the
checkpoint folder (under the session's checkpoint dir unless given) remembers which
files were done.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.functions.callables import Extractor, Tokenizer
from quill.operators.chunk import split_windows
from quill.operators.embed import HashingEmbedder
from quill.operators.extract import html_to_text
from quill.session import ensure_checkpoint_dir
from quill.sources.versions import BUCKETS, open_versioned, refresh

PAGES_SCHEMA = "page_id bigint, url string, html string"


def page_chunks(pages: DataFrame, module: str, selector: str = "article", size: int = 256,
                overlap: int = 32, embedder=None, extractor: Extractor | None = None,
                tokenizer: Tokenizer | None = None) -> DataFrame:
    """The batch pipeline shared by the stream: pages -> text -> chunks -> vectors -> store rows.
    ``extractor`` and ``tokenizer`` are the caller's own (X3, X4)."""
    embedder = embedder or HashingEmbedder()
    docs = pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("source"),
                        html_to_text(F.col("html"), selector=selector, extractor=extractor).alias("text"))
    ch = split_windows(docs, size=size, overlap=overlap, tokenizer=tokenizer)
    ch = ch.select((F.col("doc_id") * 2147483648 + F.col("chunk_index")).alias("chunk_id"),
                   (F.col("doc_id") * 2147483648 + F.col("chunk_index")).alias("ordinal"), "text",
                   F.create_map(F.lit("source"), F.col("source")).alias("metadata"), F.lit(module).alias("module"),
                   F.col("doc_id").alias("page_id"))
    return embedder.embed(ch)


def store_root(store_path: str, module: str) -> str:
    return f"{store_path.rstrip('/')}/module={module}"


def open_ingested(spark: SparkSession, store_path: str, module: str) -> DataFrame:
    """The live chunk rows of a module."""
    return open_versioned(spark, store_root(store_path, module))


def ingest_pages(spark: SparkSession, pages_dir: str, store_path: str, module: str,
                 checkpoint: str | None = None, schema: str = PAGES_SCHEMA, captured_col: str | None = None,
                 buckets: int = BUCKETS, **kw):
    """Run the stream once over the files present (``availableNow``) and wait.

    A page's captures are ordered by ``captured_col`` (a column of the files named in
    ``schema``), or by the time and name of the file they came in."""
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    ckpt = checkpoint or f"{shared}/ingest-{module}"
    stamp = (F.col(captured_col) if captured_col else
             F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_name").alias("file")))
    stream = spark.readStream.schema(schema).parquet(pages_dir).select("page_id", "url", "html", stamp.alias("stamp"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        refresh(spark, store_root(store_path, module), batch, lambda pages: page_chunks(pages, module, **kw),
                f"{shared}/ingest-staging-{uuid.uuid4().hex}", buckets=buckets)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
