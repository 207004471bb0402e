"""Vector codes of several parts, each part's nearest codebook entry found by
memoised grid cells.

A vector of integers is cut into equal parts; every part position has a codebook. Space
is cut into a grid of cubes, coarse against the codebook's spread. For a cell, an entry
whose least distance to the cube exceeds another's greatest distance to it can't be the
nearest of any point inside: what is left is cached under the cell's coordinates, and a
part is compared exactly with the entries of its cell only. The cache is per task and
codebook and holds ``CELLS`` cells a position, then starts anew.

A round is one scan of the stored rows, whose tasks send one sum per entry and
component; the driver holds the codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import stored
from quill.llm.vectors import doubles, integer_rows, sums

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Entries of a codebook at most: two hex digits.
ENTRIES_MOST = 256
#: Cells across the codebook's spread, and cells kept a position.
ACROSS = 8
CELLS = 50_000
#: Numbers in one step's arrays.
STEP = 1 << 21
#: Salts of the join with the labels' totals.
SALTS = 64


class Grid:
    """The nearest entries of one position's codebook."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.side = max(1, int((book.max(axis=0) - book.min(axis=0)).max()) // ACROSS)
        self.clear()

    def clear(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.starts, self.entries = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def candidates(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of entries, entries in ascending order) that each cell's points can be nearest to."""
        least, most = [], []
        for book in self.book:
            # Integer points: the cube's last point is side - 1 above its first.
            a, b = book - cells * self.side, cells * self.side + self.side - 1 - book
            least.append((np.maximum(np.maximum(-a, -b), 0) ** 2).sum(axis=1))
            most.append((np.maximum(np.abs(a), np.abs(b)) ** 2).sum(axis=1))
        left = np.array(least) <= np.min(most, axis=0)
        return left.sum(axis=0), np.nonzero(left.T)[1]

    def slots(self, cells: np.ndarray) -> np.ndarray:
        """Each cell's place in the cache; new cells are added."""
        raw, w = np.ascontiguousarray(cells).tobytes(), cells.shape[1] * 8
        keys = [raw[i:i + w] for i in range(0, len(raw), w)]
        if len(self.memo) > CELLS:
            self.clear()
        new = [k for k in dict.fromkeys(keys) if k not in self.memo]
        step = max(1, STEP // (len(self.book) * cells.shape[1]))
        for i in range(0, len(new), step):
            part = new[i:i + step]
            count, entries = self.candidates(np.frombuffer(b"".join(part), np.int64).reshape(len(part), -1))
            self.memo.update(zip(part, range(len(self.starts) - 1, len(self.starts) - 1 + len(part))))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(count)])
            self.entries = np.concatenate([self.entries, entries])
        return np.fromiter(map(self.memo.__getitem__, keys), np.int64, len(keys))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``x``, ties to the lower entry."""
        slots = self.slots(x // self.side)
        count = self.starts[slots + 1] - self.starts[slots]
        best = np.empty(len(x), np.int64)
        step = max(1, STEP // (len(self.book) * x.shape[1]))
        for i in range(0, len(x), step):
            n = count[i:i + step]
            at = np.cumsum(n) - n
            entry = self.entries[np.arange(n.sum()) + np.repeat(self.starts[slots[i:i + step]] - at, n)]
            d = ((np.repeat(x[i:i + step], n, axis=0) - self.book[entry]) ** 2).sum(axis=1)
            best[i:i + step] = np.minimum.reduceat(d * ENTRIES_MOST + entry, at)
        return best % ENTRIES_MOST, best // ENTRIES_MOST


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def _first(rows: DataFrame, scale: float, n: int, length: int) -> list[list[int]]:
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in integer_rows(batch.column("x"), scale, length, ENTRIES_MOST):
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), pa.array(x.tolist(), pa.list_(pa.int64()))], names=["vec_id", "v"])

    few = rows.select("vec_id", "x").mapInArrow(whole, "vec_id long, v array<long>")
    return [r["v"] for r in few.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(n).collect()]


def _coded(rows: DataFrame, length: int, parts: int, entries: int, rounds: int, scale: float) -> DataFrame | None:
    """vec_id, label, code, error, codebooks_sha256 of the vectors of one length; None without any."""
    first = _first(rows, scale, entries, length)
    if not first:
        return None
    width = length // parts
    books = np.array(first, np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in integer_rows(batch.column("x"), scale, length, ENTRIES_MOST):
                v = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, length), pa.int32()), pa.array(x.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at)) for c in ("vec_id", "label")), v], names=["vec_id", "label", "v"])

    kind = rows.schema["label"].dataType.simpleString()
    held = stored(rows.mapInArrow(whole, f"vec_id long, label {kind}, v array<int>"), "parts")
    size = width + 1
    for _ in range(rounds):
        def total(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            # For each entry the sums of its parts' components, then their number.
            out = np.zeros((*books.shape[:2], size), np.int64)
            grids = [Grid(b) for b in books]
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column("v"))
                for p, grid in enumerate(grids):
                    own = x[:, p * width:(p + 1) * width]
                    entry = grid.nearest(own)[0]
                    order = entry.argsort(kind="stable")
                    used, at = np.unique(entry[order], return_index=True)
                    out[p, used, :-1] += np.add.reduceat(own[order], at, axis=0)
                    out[p, :, -1] += np.bincount(entry, minlength=books.shape[1])
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(out.ravel()[at])], names=["slot", "value"])

        found = sums(held.select("v").mapInArrow(total, "slot int, value long"))
        moved = books.copy()
        for p in range(parts):
            for e in range(books.shape[1]):
                at = (p * books.shape[1] + e) * size
                if n := found.get(at + width, 0):
                    moved[p, e] = [found.get(at + i, 0) // n for i in range(width)]
        books = moved

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(b) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"))
            found = [grid.nearest(x[:, p * width:(p + 1) * width]) for p, grid in enumerate(grids)]
            raw = np.stack([e for e, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([raw[i:i + 2 * parts] for i in range(0, len(raw), 2 * parts)]),
                                              pa.array(sum(d for _, d in found))], names=["vec_id", "label", "code", "error"])

    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return (stored(held.mapInArrow(final, f"vec_id long, label {kind}, code string, error long"), "codes")
            .withColumn("codebooks_sha256", F.lit(digest)))


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = 256,
          id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows vec_id, code, error, label_error, codebooks_sha256 for the vectors as integers
    floor(scale * x), cut into ``parts`` equal parts.

    The codebooks start as the parts of the ``entries`` vectors of smallest id (fewer
    vectors: fewer entries; equal ids in the order of their vectors; null ids last). Each
    round assigns every part to its nearest entry, ties to the lower one, and moves every
    entry that has parts to their componentwise floor(sum / count). Then parts are assigned
    once more: ``code`` has two hex digits a part, ``error`` the squared distances summed,
    ``label_error`` the errors summed over the rows of the same label, null included.

    Vectors that are null, empty or hold a null or non-finite component are left out, and
    those whose length can't be cut into ``parts`` equal parts. Vectors of another length
    have codebooks of their own. Every row counts, repeated and null ids too. Distances are
    64-bit: a component beyond ``vectors.limit`` raises. Empty tables give no rows; other
    columns are ignored."""
    if not 0 < entries <= ENTRIES_MOST:
        raise ValueError(f"a codebook has 1 to {ENTRIES_MOST} entries")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), doubles(vector_col).alias("x"))
    lengths = sorted(r["n"] for r in rows.select(F.size("x").alias("n")).filter(f"n > 0 and n % {parts} = 0").distinct().collect())
    found = [c for n in lengths if (c := _coded(rows, n, parts, entries, rounds, scale)) is not None]
    if not found:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = reduce(DataFrame.unionAll, found)
    # Rows of a frequent label are spread over the salts, each of which meets its own copy of the total.
    total = (coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("_label"), "label_error")
             .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(total, F.expr("label <=> _label and _salt = _copy")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
