"""The training-data pipeline over ``documents``: drop toxic documents, keep one
of each group of near copies, drop leaked benchmark passages, redact secrets, pack
what is left into sequences.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
its result is written as Parquet in the folder the executors share and read back
for the next. All but the last return the columns of ``documents``. A null text
counts as empty, a row without a doc_id is kept as it is, and an empty table goes
through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.llm import decontaminate, ngram_join, packing, secrets, toxicity
from quill.llm.common import prepare, read, stored

# Toxicity and tokens can't be written in SQL: the tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the classifier doesn't call toxic."""
    prepare(spark)
    score = toxicity.scorer(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return docs.filter(score("text") < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one of smallest doc_id. Rows that
    share a doc_id are documents of their own if their texts differ: one row of each text is
    compared, under a number of its own of 2^62 and above, so that of a class the smallest
    id of one row stays, and without any the smallest of these numbers."""
    prepare(spark)
    known, none = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    again = stored(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    rows = known.withColumn("key", F.col("doc_id"))
    if again.take(1):  # an id on several rows is rare: only those rows are moved
        number = F.lit(2**62) + F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(2**61))
        many = known.join(again, "doc_id", "left_semi").groupBy(number.alias("key")).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*", "key")
        rows = stored(rows.join(again, "doc_id", "left_anti").select(*docs.columns, "key").unionAll(many.select(*docs.columns, "key")), "rows")
    kept = stored(ngram_join.classes(rows, id_col="key").filter("doc_id = class_id").select(F.col("doc_id").alias("key")), "kept")
    return rows.join(kept, "key", "left_semi").select(docs.columns).unionAll(none)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that leak no benchmark passage."""
    prepare(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its secrets replaced by a mark and ``n_chars`` counted anew."""
    prepare(spark)
    redact = secrets.redactor(docs, secrets.fit(docs))
    out = docs.withColumn("text", redact("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("decontamination", drop_leaks),
          ("secrets", redact_secrets), ("packing", pack_documents)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
