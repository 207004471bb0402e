"""Token-id files: one concatenated id array per segment, its document
boundaries as an Elias-Fano sequence.

A segment is one Parquet row (``part``, ``seq``, ``n_docs``, ``n_ids``,
``blob``), so that any file system Spark writes to will do and a lost task
leaves nothing behind. The blob holds, little-endian: magic, id width (2 or 4
bytes), counts, the document ids and the document ends, each as an Elias-Fano
sequence, then the id array. Rows stand in ascending document-id order: by
``part``, then ``seq``, then place in the segment.

An Elias-Fano sequence of n values up to u keeps l = floor(log2(u / n)) low bits
of each value packed, and the rest as a bit vector with one 1 for each value, at
most 2n + 1 bits long: about 2 + log2(u / n) bits a value. Every 256th 1's place
is kept, so ``select`` reads one sample and a short run of bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.common import shared_path, slices, texts_of
from quill.llm.tokens import encoder, vocabulary_path

MAGIC = b"QEF1"
SAMPLE = 256
SEGMENT_IDS = 1_000_000  # a segment ends once it holds this many ids
BATCH_CHARS = 2_000_000
POPCOUNT = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# Place of the k-th 1 of a byte.
PLACE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, "<u4"))
        l = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = (v[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)
        ones = (v >> np.uint64(l)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(n, l, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """The i-th value: from the sample before it, over the bytes between."""
        at = int(self.samples[i // SAMPLE])
        need = i % SAMPLE
        byte, bit = divmod(at, 8)
        word = self.high[byte] >> bit << bit
        while (ones := int(POPCOUNT[word])) <= need:
            need -= ones
            byte += 1
            word = self.high[byte]
        for _ in range(need):
            word &= word - 1
        at = 8 * byte + (word & -word).bit_length() - 1
        start = i * self.low_bits
        low = int.from_bytes(self.low[start // 8:(start + self.low_bits + 7) // 8], "little")
        return (at - i) << self.low_bits | low >> start % 8 & (1 << self.low_bits) - 1

    def select_many(self, at: np.ndarray) -> np.ndarray:
        """The values at these places, as unsigned 64-bit integers."""
        if self.low_bits > 56 or not len(at):  # a value's low bits can cross nine bytes
            return np.array([self.select(int(i)) for i in at], np.uint64)
        high = np.frombuffer(self.high, np.uint8)
        ones = np.cumsum(POPCOUNT[high], dtype=np.int64)
        byte = np.searchsorted(ones, at, side="right")
        place = 8 * byte + PLACE[high[byte], at - (ones[byte] - POPCOUNT[high[byte]])]
        out = (place - at).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            low = np.concatenate([np.frombuffer(self.low, np.uint8), np.zeros(8, np.uint8)])
            start = at * self.low_bits
            word = low[(start // 8)[:, None] + np.arange(8)].view("<u8")[:, 0]
            out |= word >> (start % 8).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def read(cls, raw: memoryview, at: int) -> tuple[EliasFano, int]:
        n, l, a, b, s = struct.unpack_from("<QBQQQ", raw, at)
        at += struct.calcsize("<QBQQQ")
        low, high = bytes(raw[at:at + a]), bytes(raw[at + a:at + a + b])
        at += a + b
        return cls(n, l, low, high, np.frombuffer(raw[at:at + 4 * s], "<u4")), at + 4 * s


def pack_segment(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One segment's blob from documents in ascending id order (null ids
    first) and each document's ids as 32-bit bytes."""
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    # A span beyond 63 bits is still exact: numpy holds it unsigned.
    order = np.array([d - least for d in known], np.uint64)
    ends = np.cumsum([len(b) // 4 for b in ids])
    body = np.frombuffer(b"".join(ids), "<u4").astype("<u2" if width == 2 else "<u4").tobytes()
    return (MAGIC + struct.pack("<BqQ", width, least, len(doc_ids) - len(known))
            + EliasFano.of(order).to_bytes() + EliasFano.of(ends).to_bytes() + body)


def unpack_segment(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, document ends (in ids) and the id array of a segment, the first two by select."""
    if blob[:4] != MAGIC:
        raise ValueError("not a token-id segment")
    raw = memoryview(blob)
    width, least, nulls = struct.unpack_from("<BqQ", raw, 4)
    order, at = EliasFano.read(raw, 4 + struct.calcsize("<BqQ"))
    ends, at = EliasFano.read(raw, at)
    docs = [None] * nulls + [least + x for x in order.select_many(np.arange(order.n)).tolist()]
    return docs, ends.select_many(np.arange(ends.n)).astype(np.int64), np.frombuffer(raw[at:], "<u2" if width == 2 else "<u4")


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int,
                    id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write
    segments in ascending order of ``id_col`` (null ids first; rows of one id by
    text). Other columns are ignored; an empty table writes no segment."""
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer_path)
        width = 2 if max(enc.size, end_id + 1) <= 1 << 16 else 4
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        count = 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "n_docs": [len(held)], "n_ids": [count],
                 "blob": [pack_segment(doc_ids, held, width)]}, schema=SEGMENT)

        for batch in batches:
            texts, names = texts_of(batch), batch.column("doc_id").to_pylist()
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                for d, ids in zip(names[a:b], enc.encode(texts[a:b])):
                    doc_ids.append(d)
                    held.append(ids + end)
                    count += len(ids) // 4 + 1
                    if count >= SEGMENT_IDS:
                        yield segment()
                        seq, doc_ids, held, count = seq + 1, [], [], 0
        if held:
            yield segment()

    rows.mapInArrow(encode, "part int, seq int, n_docs long, n_ids long, blob binary").write.parquet(path)


SEGMENT = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                     ("n_ids", pa.int64()), ("blob", pa.binary())])
_READ = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_token_ids(spark, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (over its ids as unsigned 32-bit)."""
    segments = spark.read.schema("part int, seq int, n_docs long, n_ids long, blob binary").parquet(path)
    # Ids before a segment: those of the parts before (a row a part), and of its own part's segments before.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select(F.col("part").alias("_p"), F.col("seq").alias("_s"), F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("_own"))
    starts = starts.join(parts, F.expr("_p = _part")).select("_p", "_s", (F.col("_first") + F.col("_own")).alias("first"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(batch.column("part").to_pylist(), batch.column("seq").to_pylist(), batch.column("blob")):
                docs, ends, ids = unpack_segment(blob.as_py())
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {"part": np.full(len(docs), part, np.int32), "seq": np.full(len(docs), seq, np.int32),
                     "doc_id": docs, "start": starts, "n_tokens": ends - starts, "ids_crc32": crc}, schema=_READ)

    # The files are read where they lie: only a document's numbers meet its segment's start.
    read = segments.select("part", "seq", "blob").mapInArrow(decode, "part int, seq int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return (read.join(starts, F.expr("part = _p and seq = _s"))
            .select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))


def token_id_table(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write ``docs`` as token-id files and read them back: a row per row of ``docs`` with
    doc_id, start, n_tokens and ids_crc32. Null texts are empty, null ids come first,
    repeated ids in the order of their texts; an empty table gives no rows, other
    columns are ignored, and texts are encoded whole, however long."""
    path = path or shared_path(docs.sparkSession, "token-ids")
    write_token_ids(docs, path, vocabulary_path(tokenizer), end_id)
    return read_token_ids(docs.sparkSession, path)
