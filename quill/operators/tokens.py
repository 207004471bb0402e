"""Token statistics: A1 (tokens per document and total), A2 (token report),
J9 (model -> encoding lookup)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.functions.text import count_tokens

# Model name -> tokenizer encoding, the known encoding names and
# the fallback encoding.
MODEL_ENCODINGS = {
    "gpt-4o": "o200k_base",
    "gpt-4": "cl100k_base",
    "gpt-3.5": "cl100k_base",
    "codex": "p50k_base",
    "davinci": "r50k_base",
    "claude-3.5": "cl100k_base",
    "claude-3": "cl100k_base",
}
KNOWN_ENCODINGS = ["gpt2", "r50k_base", "p50k_base", "p50k_edit", "cl100k_base", "o200k_base"]
FALLBACK_ENCODING = "cl100k_base"


def encoding_table(spark) -> DataFrame:
    return spark.createDataFrame(list(MODEL_ENCODINGS.items()), "model string, encoding string")


def resolve_encoding(df: DataFrame, model_col: str = "model") -> DataFrame:
    """Mapped encoding, else the name itself when it is an encoding, else the fallback.
    The mapping is a fixed seven-row table: broadcast is safe."""
    enc = encoding_table(df.sparkSession).withColumnRenamed("model", "_m")
    j = df.join(F.broadcast(enc), F.col(model_col) == F.col("_m"), "left")
    name = F.col(model_col)
    return j.withColumn("encoding", F.coalesce(
        F.col("encoding"), F.when(name.isin(KNOWN_ENCODINGS), name), F.lit(FALLBACK_ENCODING))).drop("_m")


def with_token_counts(df: DataFrame, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    return df.withColumn(out_col, count_tokens(F.col(text_col)))


def tokens_by(df: DataFrame, group_col: str, tokens_col: str = "n_tokens") -> DataFrame:
    """A1: documents and tokens per group plus the grand total (group null), one pass."""
    return (df.rollup(group_col)
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(tokens_col).cast("bigint").alias("total_tokens")))


def token_report(df: DataFrame, group_cols: list[str], text_col: str = "text") -> DataFrame:
    """A2: files, characters, tokens, characters per token to 2 places (null when no tokens)."""
    t = df.select(*group_cols, F.length(text_col).alias("_c"), count_tokens(F.col(text_col)).alias("_t"))
    agg = t.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("_c").cast("bigint").alias("total_chars"),
        F.sum("_t").cast("bigint").alias("total_tokens"))
    return agg.withColumn("chars_per_token", F.when(
        F.col("total_tokens") > 0, F.round(F.try_divide(F.col("total_chars"), F.col("total_tokens")), 2)))


_BPE_CACHE: dict[str, object] = {}


def _bpe(path: str):
    tok = _BPE_CACHE.get(path)
    if tok is None:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        _BPE_CACHE[path] = tok
    return tok


def count_tokens_bpe(text_col, tokenizer_file: str) -> F.Column:
    """F3 with a BPE (or any) tokenizer saved by the ``tokenizers`` library
    (a ``tokenizer.json``), counted in Arrow batches; the file is read once per
    Python worker. Use a path every executor can read. Null text counts 0."""

    def _count(s: pd.Series) -> pd.Series:
        tok = _bpe(tokenizer_file)
        texts = s.fillna("").tolist()
        return pd.Series([len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)], dtype="int32")

    col = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.pandas_udf(_count, "int")(col)
