"""Removal of long repeated byte strings, by suffix sorting of shards.

Every 400-byte string holds one anchor, its leftmost smallest 16-byte hash. Strings
next to each other share it, so a text falls into short runs of strings with one
anchor, about one per 100 bytes; the bytes that all strings of a run have in common
(208 of them or more) are the run's key. Equal strings always lie in runs of one key.

* A key seen once: none of its strings repeats.
* A key whose runs are all equal: all of them repeat. One grouped count, partial
  sums first, decides these, however many copies there are.
* Else the key's different runs are brought together, one of each, and their
  suffixes are sorted by induction (``suffixsort``); strings that share 400 bytes
  with a neighbour in that order repeat. Shards hold whole keys, up to
  ``SHARD_BYTES``, and are sorted in memory.
* A key whose different runs are more than that is split: each of its runs is cut
  into shorter ones (an eighth of the strings, by their distance from the anchor),
  whose strings have more bytes in common on both sides, and these longer keys go
  through the same steps. At one string a run the key is the string itself.

Keys and runs are compared by independent 64-bit hashes, 128 bits together.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import mix64, shuffle_parts, stored
from quill.llm.ngram_join import _groups, powers
from quill.llm.suffixsort import repeated

LENGTH = 400
GRAM = 16
SHARD_BYTES = 2_000_000

_RUNS = pa.schema([("rid", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("key", pa.int64()), ("seg", pa.int64())])


def _prefix(b: np.ndarray, seed: int, power: np.ndarray) -> np.ndarray:
    return np.concatenate([[np.uint64(0)], np.cumsum(mix64(np.arange(256, dtype=np.uint64), seed)[b] * power[:len(b)])])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours: block-wise from both sides."""
    n = len(x)
    pad = np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def widths(length: int) -> list[int]:
    """Most strings of a run, level after level: half the anchor's places, then
    an eighth of the level before, down to one."""
    out = [(length - GRAM) // 2 + 1]
    while out[-1] > 1:
        out.append(max(1, out[-1] // 8))
    return out


def runs(b: np.ndarray, power: np.ndarray, back: np.ndarray, length: int = LENGTH, width: int | None = None):
    """Runs of one text (of at most ``width`` strings): first and last string
    start, key, and hash of all the run's bytes (with the place of the anchor)."""
    width = width or widths(length)[0]
    with np.errstate(over="ignore"):
        p0, p1 = _prefix(b, 1, power), _prefix(b, 2, power)
        n = len(b)
        grams = mix64((p0[GRAM:] - p0[:-GRAM]) * back[:n - GRAM + 1])
        marked = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_min(marked, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(len(anchor))
        side = (anchor - starts) // width  # the part of the string that the anchor is in
        cut = np.flatnonzero(np.diff(anchor * length + side))
        lo, hi = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(anchor) - 1]])
        at, part = anchor[lo], side[lo]
        # All strings of the run hold these bytes, wherever in the run they start.
        k0 = at - part * width
        k1 = k0 + length - width + 1
        key = mix64((p0[k1] - p0[k0]) * back[k0] + part.astype(np.uint64), 4)
        end = hi + length
        seg = mix64((p1[end] - p1[lo]) * back[lo] + mix64((end - lo) * 1024 + (at - lo), 6), 5)
    return lo, hi, key.astype(np.int64), seg.astype(np.int64)


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in batch.column("text").to_pylist()]


def _find_runs(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power, back = powers(1 << 16)
        for batch in batches:
            names = batch.column("rid").to_pylist()
            rows: list[tuple] = []
            held = 0
            for rid, raw in zip(names, map(zlib.decompress, batch.column("z").to_pylist())):
                if len(raw) < length:
                    continue
                if len(raw) > len(power):
                    power, back = powers(2 * len(raw))
                lo, hi, key, seg = runs(np.frombuffer(raw, np.uint8), power, back, length)
                rows.append((np.full(len(lo), rid), lo, hi, key, seg))
                held += len(lo)
                if held > 100_000:
                    yield _batch(rows, _RUNS)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, _RUNS)
    return find


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the store and the shuffles."""
    for batch in batches:
        z = [zlib.compress(b, 1) for b in _encoded(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(z, pa.binary())], names=["rid", "doc_id", "z"])


def _cut_runs(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, z, wanted in zip(*(batch.column(c).to_pylist() for c in ("rid", "z", "wanted"))):
                raw = zlib.decompress(z)
                yield pa.RecordBatch.from_pydict(
                    {"key": [w["key"] for w in wanted], "n": [w["n"] for w in wanted], "rid": [rid] * len(wanted), "lo": [w["lo"] for w in wanted],
                     "bytes": [raw[w["lo"]:w["hi"] + length] for w in wanted]},
                    schema=pa.schema([("key", pa.int64()), ("n", pa.int64()), ("rid", pa.int64()), ("lo", pa.int32()), ("bytes", pa.binary())]))
    return cut


def _split_runs(length: int, width: int):
    """The wanted runs cut into runs of at most ``width`` strings. A run's bytes
    hold its anchor, so they are cut as a text of their own."""
    schema = pa.schema([*_RUNS, ("copies", pa.int64())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power, back = powers(1 << 12)
        for batch in batches:
            for rid, z, wanted in zip(*(batch.column(c).to_pylist() for c in ("rid", "z", "wanted"))):
                raw = np.frombuffer(zlib.decompress(z), np.uint8)
                rows = []
                for w in wanted:
                    lo, hi, key, seg = runs(raw[w["lo"]:w["hi"] + length], power, back, length, width)
                    rows.append((np.full(len(lo), rid), lo + w["lo"], hi + w["lo"], key, seg, np.full(len(lo), w["n"])))
                yield _batch(rows, schema)
    return split


def _sort_shards(length: int):
    def judge(shard: list[tuple]) -> pa.RecordBatch | None:
        hits = repeated([np.frombuffer(s[3], np.uint8) for s in shard], length)
        out: list[tuple] = []
        for (n, rid, lo, _), hit in zip(shard, hits):
            if n == 1:  # runs with a copy are known to repeat
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                out += [(rid, lo + a, lo + b - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32()))], names=["rid", "lo", "hi"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        held = 0
        for group in _groups(batches, ["key"]):
            rows = list(zip(*(group[c] for c in ("n", "rid", "lo", "bytes"))))
            size = sum(len(r[3]) for r in rows)
            if shard and held + size > SHARD_BYTES:
                if (out := judge(shard)) is not None:
                    yield out
                shard, held = [], 0
            shard += rows
            held += size
        if shard and (out := judge(shard)) is not None:
            yield out
    return sort


def _remove(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, z, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "z", "found"))):
                raw = zlib.decompress(z)
                kept, at, removed, spans = hashlib.sha256(), 0, 0, 0
                end = -1
                for s in sorted(found or [], key=lambda s: s["lo"]):
                    lo, hi = s["lo"], s["hi"] + length
                    if lo > end:  # a new maximal run of removed bytes
                        if end >= 0:
                            removed += end - start
                        kept.update(raw[at:lo])
                        start, spans = lo, spans + 1
                    end = at = max(end, hi)
                if spans:
                    removed += end - start
                kept.update(raw[at:])
                rows.append((doc_id, len(raw), removed, spans, kept.hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256. A byte goes if a ``length``-byte string over it also starts
    anywhere else; both places lose it. Null texts count as empty; texts shorter than
    ``length`` lose nothing; repeated rows are texts of their own, so each makes the
    other repeat. Texts are read whole, in a task's memory one by one, so it grows with the
    longest. Empty tables give no rows; other columns are ignored."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Written once: a row keeps its number whatever is computed again later.
    packed = stored(texts.mapInArrow(_packed, "rid long, doc_id long, z binary"), "texts")
    schema = "rid long, lo int, hi int, key long, seg long"
    found = stored(packed.select("rid", "z").mapInArrow(_find_runs(length), schema), "runs").withColumn("copies", F.lit(1))
    spans = []
    for finer in [*widths(length)[1:], 0]:
        keys = (found.groupBy("key").agg(F.count("*").alias("n"), F.min("seg").alias("a"), F.max("seg").alias("b")).filter("n > 1")
                .select("key", (F.col("a") != F.col("b")).alias("mixed")))
        seen = stored(found.join(keys, "key"), "repeated-keys")
        whole = seen.filter("not mixed").select("rid", "lo", "hi")
        mixed = seen.filter("mixed")
        kinds = stored(mixed.groupBy("key", "seg").agg(F.count("*").alias("rows"), F.sum("copies").alias("n"), F.min(F.struct("rid", "lo", "hi")).alias("r")), "kinds")
        copied = mixed.join(kinds.filter("rows > 1").select("key", "seg"), ["key", "seg"]).select("rid", "lo", "hi")
        large = kinds.groupBy("key").agg(F.sum(F.expr(f"r.hi - r.lo + {length}")).alias("bytes")).filter(F.col("bytes") > SHARD_BYTES).select("key")
        split = bool(finer) and bool((large := stored(large, "large-keys")).take(1))

        def wanted(of: DataFrame) -> DataFrame:
            of = of.select("r.*", "key", "n").groupBy("rid").agg(F.collect_list(F.struct("key", "n", "lo", "hi")).alias("wanted"))
            return packed.join(of, "rid").select("rid", "z", "wanted")

        single = (wanted(kinds.join(large, "key", "left_anti") if split else kinds)
                  .mapInArrow(_cut_runs(length), "key long, n long, rid long, lo int, bytes binary")
                  .repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_sort_shards(length), "rid long, lo int, hi int"))
        spans.append(stored(whole.unionAll(copied).unionAll(single), "spans"))
        if not split:
            break
        found = stored(wanted(kinds.join(large, "key", "left_semi")).mapInArrow(_split_runs(length, finer), f"{schema}, copies long"), "runs")
    spans = reduce(DataFrame.unionAll, spans)
    per_text = spans.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    return (packed.join(per_text, "rid", "left").select("doc_id", "z", "found")
            .mapInArrow(_remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
