"""A store of page chunks that is refreshed page by page.

Pages are dealt into a fixed number of buckets. A refresh writes the buckets that it
touches anew, under the next version number, and then a manifest that names the live
version of every bucket. Readers follow the newest complete manifest, so all buckets
change at once; a refresh that dies before its manifest has changed nothing.

    <root>/data/version=7/bucket=3/part-*.parquet    chunk rows
    <root>/pages/version=7/bucket=3/part-*.parquet   page and stamp of its live capture
    <root>/manifest/000000000007/part-*.txt          JSON; complete when _SUCCESS is there

Each page has a stamp that grows with its captures. A capture counts only if its stamp is
higher than the live one's, so replayed or late files change nothing. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quill.sources.files import path_exists

BUCKETS = 64


def _list(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The newest complete manifest: version, buckets, live (bucket to version) and the
    schemas of both tables; None without one."""
    for name in reversed(_list(spark, f"{root}/manifest")):
        if path_exists(spark, f"{root}/manifest/{name}/_SUCCESS"):
            return json.loads(spark.read.text(f"{root}/manifest/{name}").first()["value"])
    return None


def _live(spark: SparkSession, root: str, table: str, found: dict, buckets: list[int] | None = None) -> DataFrame:
    """Rows of the live version of each bucket (all, or the given): partition filters only."""
    by: dict[int, list[int]] = {}
    for b, v in found["live"].items():
        if buckets is None or int(b) in buckets:
            by.setdefault(v, []).append(int(b))
    want: Column = F.lit(False)
    for v, own in by.items():
        want = want | ((F.col("version") == v) & F.col("bucket").isin(own))
    schema = StructType.fromJson(found["schemas"][table]).add("version", "long").add("bucket", "integer")
    return spark.read.schema(schema).parquet(f"{root}/{table}").filter(want)


def open_versioned(spark: SparkSession, root: str) -> DataFrame:
    """The live chunk rows."""
    found = manifest(spark, root)
    if found is None:
        raise ValueError(f"no complete version of a store: {root}")
    return _live(spark, root, "data", found).drop("version", "bucket")


def refresh(spark: SparkSession, root: str, captures: DataFrame, build: Callable[[DataFrame], DataFrame], staging: str,
            key: str = "page_id", stamp: str = "stamp", buckets: int = BUCKETS) -> int:
    """Bring ``captures`` (``key``, ``stamp`` and what ``build`` needs) into the store: the live
    chunks of a page become those that ``build`` makes of its newest capture, or none, if
    it makes none. ``build`` returns store rows with ``key``. Returns the live version, which
    stays as it is if no capture is newer. Rows without a key or stamp are left out; of several
    captures with the newest stamp the one with the greatest other columns counts.
    ``staging`` is a fresh folder all executors share, for the captures that count."""
    found = manifest(spark, root) or {"version": 0, "buckets": buckets, "live": {}, "schemas": {}}
    bucket = F.pmod(F.xxhash64(key), F.lit(found["buckets"])).cast("int").alias("bucket")
    others = [c for c in captures.columns if c not in (key, stamp)]
    newest = (captures.filter(F.col(key).isNotNull() & F.col(stamp).isNotNull()).groupBy(key)
              .agg(F.max_by(F.struct(stamp, *others), F.struct(stamp, *others)).alias("_c")).select(key, "_c.*"))
    if found["live"]:
        there = _live(spark, root, "pages", found).select(F.col(key).alias("_key"), F.col(stamp).alias("_stamp"))
        newest = (newest.join(there, newest[key] == there["_key"], "left")
                  .filter(F.col("_stamp").isNull() | (F.col(stamp) > F.col("_stamp"))).drop("_key", "_stamp"))
    newest.withColumn("bucket", bucket).write.parquet(staging)
    fresh = spark.read.parquet(staging)
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
    if not touched:
        return found["version"]
    version = found["version"] + 1
    rows = build(fresh.drop("bucket")).withColumn("bucket", bucket)
    stamps = fresh.select(key, stamp, "bucket")
    schemas = {"data": rows.drop("bucket").schema, "pages": stamps.drop("bucket").schema}
    for table, new in (("data", rows), ("pages", stamps)):
        if found["live"]:
            held = _live(spark, root, table, found, touched).join(fresh.select(key), key, "left_anti")
            new = new.unionByName(held.select(new.columns))
        # Even files, whatever a bucket's size; a version left by a run that died goes.
        (new.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{table}/version={version}"))
    live = found["live"] | {str(b): version for b in touched}
    text = json.dumps({"version": version, "buckets": found["buckets"], "live": live,
                       "schemas": {t: s.jsonValue() for t, s in schemas.items()}})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/manifest/{version:012d}")
    return version


def drop_unused(spark: SparkSession, root: str) -> list[int]:
    """Delete the versions that the live manifest doesn't name, and older manifests; run it
    when no reader holds an older one. Returns the versions deleted."""
    found = manifest(spark, root)
    if found is None:
        return []
    used, gone = set(found["live"].values()), set()
    for table in ("data", "pages"):
        for name in _list(spark, f"{root}/{table}"):
            v = int(name.partition("=")[2] or 0)
            if name.startswith("version=") and v not in used and v <= found["version"]:
                _delete(spark, f"{root}/{table}/{name}")
                gone.add(v)
    for name in _list(spark, f"{root}/manifest"):
        if int(name) < found["version"]:
            _delete(spark, f"{root}/manifest/{name}")
    return sorted(gone)
