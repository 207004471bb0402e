"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.session import ensure_checkpoint_dir, ship_package
from quill.sources.tables import stored  # noqa: F401  the operators take it from here


PART = 64  # texts that a task holds as Python strings at once


def prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, by Spark's reader (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the value as text, modulo m; a null value gives null."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(m)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as strings, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def text_parts(column: pa.Array, rows: int = PART) -> Iterator[list[str]]:
    """The strings of a batch's column, some rows at a time, null as empty: a whole batch
    as Python strings takes several times its bytes."""
    for a in range(0, len(column), rows):
        yield [t or "" for t in column.slice(a, rows).to_pylist()]


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of items whose sizes add up to about ``limit``; an item
    larger than that stands alone."""
    a, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > limit:
            yield a, i
            a, total = i, 0
        total += s
    if a < len(sizes):
        yield a, len(sizes)


class Memo(dict):
    """``memo[key]`` computes what is missing. It holds ``size`` keys besides those
    ``known`` from the start: with half of them it starts anew and keeps that half aside, so
    that frequent keys stay; keys longer than ``longest`` are computed each time."""

    def __init__(self, compute: Callable[[str], Any], size: int, longest: int, known: dict[str, Any] | None = None):
        self.known, self.aside = known or {}, {}
        super().__init__(self.known)
        self.compute, self.most, self.longest = compute, size // 2 + len(self.known), longest

    def __missing__(self, key: str) -> Any:
        value = self.aside.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.aside = {k: v for k, v in self.items() if k not in self.known}
                self.clear()
                self.update(self.known)
            self[key] = value
        return value


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) over an unsigned array."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
