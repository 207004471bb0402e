"""Best-fit packing with a Martello-Toth reduction.

Documents become pieces of at most ``capacity`` ids. The instance is the
histogram of piece lengths, at most ``capacity`` numbers however many rows there
are, so planning is a driver step of bounded size while pieces are ranked and
placed by Spark.

Reduction: take lengths from the longest down and fix a set that dominates every
other set the longest piece could share a sequence with:

* nothing fits beside it: it stands alone;
* a piece fills the rest exactly: the pair dominates, since whatever else could
  stand there can take that piece's place elsewhere;
* only one more piece can fit (even the two smallest don't): the largest that
  fits dominates;
* at most two more can fit, and the largest single piece that fits is no shorter
  than any two that fit together: that single piece dominates.

What no rule fixes is packed by best fit, longest first.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.common import shuffle_parts, slices, stored, texts_of
from quill.llm.tokens import encoder, vocabulary_path

BATCH_CHARS = 2_000_000
BUCKET_ROWS = 20_000
# A pattern: runs (length, how many) placed one after another, and in how many sequences.
Pattern = tuple[tuple[tuple[int, int], ...], int]

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of each whole text (null: empty) and one end id, cut every
    ``capacity`` ids: doc_id, piece, start, length, ids_crc32."""
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            texts, names = texts_of(batch), batch.column("doc_id").to_pylist()
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                rows = [(d, k // step, k // 4, (min(k + step, len(raw)) - k) // 4, zlib.crc32(raw[k:k + step]))
                        for d, ids in zip(names[a:b], enc.encode(texts[a:b])) for raw in [ids + end]
                        for k in range(0, len(raw), step)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Lengths:
    """Lengths still unplaced, ascending, with their counts."""

    def __init__(self, histogram: dict[int, int]):
        self.count = {l: c for l, c in histogram.items() if c > 0}
        self.order = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.order.remove(length)

    def smallest(self, n: int, without: int) -> list[int]:
        """The n smallest pieces, one of length ``without`` left aside."""
        out: list[int] = []
        for l in self.order:
            out += [l] * min(n - len(out), self.count[l] - (l == without))
            if len(out) == n:
                break
        return out

    def largest(self, limit: int, without: int) -> int:
        """The largest piece of at most ``limit``, one of ``without`` left aside; 0 if none."""
        k = bisect_right(self.order, limit)
        while k and self.order[k - 1] == without and self.count[without] == 1:
            k -= 1
        return self.order[k - 1] if k else 0

    def best_pair(self, limit: int, without: int) -> int:
        """The largest sum of two pieces within ``limit``; 0 if none."""
        left = dict(self.count)
        left[without] -= 1
        order = [l for l in self.order if left[l]]
        best, i, j = 0, 0, len(order) - 1
        while i <= j:
            s = order[i] + order[j]
            if s > limit:
                j -= 1
            else:
                if i < j or left[order[i]] > 1:
                    best = max(best, s)
                i += 1
        return best


def reduce_instance(histogram: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fixed patterns, and the histogram of what is left."""
    left = _Lengths(histogram)
    fixed: list[Pattern] = []
    for l in sorted(histogram, reverse=True):
        while left.count.get(l):
            n, room = left.count[l], capacity - l
            small = left.smallest(3, l)
            if not small or small[0] > room:
                fixed.append((((l, 1),), n if not small or small[0] != l else n))
                left.take(l, n)
                continue
            partner = left.largest(room, l)
            single = len(small) < 2 or small[0] + small[1] > room
            if not (partner == room or single):
                three = len(small) == 3 and sum(small) <= room
                if three or left.best_pair(room, l) > partner:
                    break
            k = n // 2 if partner == l else min(n, left.count[partner])
            fixed.append((((l, 2),) if partner == l else ((l, 1), (partner, 1)), k))
            left.take(l, 2 * k if partner == l else k)
            if partner != l:
                left.take(partner, k)
    return fixed, left.count


def best_fit(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first. Sequences filled alike stay one group, so the
    work follows the number of lengths, not of pieces."""
    groups: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(pattern: tuple[tuple[int, int], ...], n: int, room: int) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        groups[room].append((pattern, n))

    for l in sorted(histogram, reverse=True):
        n = histogram[l]
        while n:
            k = bisect_right(rooms, l - 1)
            if k == len(rooms):
                put((), n, capacity)  # new sequences; those not needed go again
                k = bisect_right(rooms, l - 1)
            room = rooms[k]
            pattern, m = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[k]
            each = room // l
            whole, rest = min(m, n // each), 0
            if whole:
                put((*pattern, (l, each)), whole, room - l * each)
            if whole < m and n - whole * each:
                rest = min(n - whole * each, each)
                put((*pattern, (l, rest)), 1, room - l * rest)
            spare = m - whole - (rest > 0)
            if spare and pattern:
                put(pattern, spare, room)
            n -= whole * each + rest
    return [g for room in rooms for g in groups[room]]


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, left = reduce_instance(histogram, capacity)
    return fixed + best_fit(left, capacity)


def _slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces a sequence, first sequence, offset)."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for runs, m in patterns:
        offset = 0
        for l, q in runs:
            out.setdefault(l, []).append((rank.get(l, 0), q, sequence, offset))
            rank[l] = rank.get(l, 0) + q * m
            offset += l * q
        sequence += m
    return {l: np.array(v, np.int64) for l, v in out.items()}


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pack every document: a row per piece with doc_id, piece, start, length,
    ids_crc32, sequence_id, offset. Null texts count as empty (one end id);
    repeated rows are packed once each; an empty table gives no rows; other
    columns are ignored. Pieces of one length are interchangeable: which of
    them takes which slot follows a hash of the document."""
    spark = docs.sparkSession
    rows = stored(pieces(docs, vocabulary_path(tokenizer), end_id, capacity), "pieces")
    counted = rows.groupBy("length").count().collect()  # at most ``capacity`` rows
    histogram = {r["length"]: r["count"] for r in counted}
    slots = spark.sparkContext.broadcast(_slots(plan(histogram, capacity)))
    # Rank within a length, hot lengths spread over buckets: places before a
    # bucket come from its counts, places inside it from a small window.
    buckets = max(shuffle_parts(spark), sum(histogram.values()) // BUCKET_ROWS + 1)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (dealt.withColumn("place", F.row_number().over(inside) - 1).join(first, ["length", "bucket"])
              .select(*_PIECES.names, (F.col("first") + F.col("place")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:]):
                at, l = order[a:b], int(length[order[a]])
                slot = table[l][np.searchsorted(table[l][:, 0], rank[at], side="right") - 1]
                step = rank[at] - slot[:, 0]
                sequence[at] = slot[:, 2] + step // slot[:, 1]
                offset[at] = slot[:, 3] + step % slot[:, 1] * l
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in _PIECES.names), pa.array(sequence), pa.array(offset)],
                names=[*_PIECES.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
