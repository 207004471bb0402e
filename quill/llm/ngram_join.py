"""N-gram Jaccard join by chosen paths.

A document is its set of five-word shingles; two link at a Jaccard similarity of
0.8 or more. Documents with equal sets are one class member (``rep``: the
smallest doc_id) before any pair is looked at.

Chosen paths: in each run a set walks a tree. At every node it follows each of
its tokens whose hash under that node falls below 1 / (0.8 |set|), so two similar
sets follow on average one common token and unlike sets almost none. A path
depends on its own set only, so all paths are computed where the text is. Sets
are split by their paths of depth 2; buckets of at most ``BUCKET`` sets are
brute-forced on 64-byte sketches, larger ones are split again by the next two
tokens, and a bucket that is still large there is taken whole. Runs repeat until a pair at
the threshold shares a path of the second depth, and so one of the first too, with
probability ``recall`` (``runs_for``).

What buckets join becomes candidate groups (connected components); inside a
group every pair is compared exactly, in blocks of ``BLOCK`` sets dealt out as
pairs of blocks, so one group of copies spreads over many tasks and a link missed
by one bucket is still found through the group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import mix64, shuffle_parts, slices, stored, texts_of
from quill.llm.graph import components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.995
DEPTHS = (2, 4)
BUCKET = 256
BLOCK = 256
SKETCH = 64
SKETCH_LEAST = 0.55  # five standard deviations below 0.8
BATCH_CHARS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def runs_for(recall: float, depth: int) -> int:
    """Runs until a pair at the threshold shares a path of ``depth`` with this
    probability: the common paths form a branching process of mean 1."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's first n powers modulo 2^64, and their inverses."""
    out = []
    for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Each text's shingles as sorted distinct 64-bit hashes. Words are the
    white-space parts of the lower-cased text; with one to four words the whole
    text is the one shingle, with none the set is empty."""
    words = [t.lower().split() for t in texts]
    flat = np.frombuffer((" ".join(" ".join(w) for w in words if w) + " ").encode(), np.uint8)
    if len(flat) <= 1:
        return [np.zeros(0, np.uint64) for _ in texts]
    with np.errstate(over="ignore"):
        power, back = powers(len(flat))
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(np.arange(256, dtype=np.uint64))[flat] * power)])
        ends = np.flatnonzero(flat == 32)
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = mix64((total[ends] - total[starts]) * back[starts])
        grams = np.zeros(len(h), np.uint64)
        for k in range(min(WORDS, len(h))):
            grams[:len(h) - k] = grams[:len(h) - k] * _BASE + h[k:]
        grams = mix64(grams)
    out, at = [], 0
    for w in words:
        n = len(w)
        if n >= WORDS:
            out.append(np.unique(grams[at:at + n - WORDS + 1]))
        elif n:
            out.append(mix64(np.add.reduce(h[at:at + n] * (np.arange(n, dtype=np.uint64) * np.uint64(2) + np.uint64(3)), keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def sketch(s: np.ndarray) -> bytes:
    """64 minima, one byte of each, by one-permutation hashing with rotation."""
    h = mix64(s, 7)
    bins = (h >> np.uint64(58)).astype(np.int64)
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, bins, h & np.uint64((1 << 58) - 1))
    full = np.zeros(SKETCH, bool)
    full[bins] = True
    # An empty bin takes the next full one's value, marked by the distance.
    places = np.flatnonzero(full)
    take = places[np.searchsorted(places, np.arange(SKETCH)) % len(places)]
    step = (take - np.arange(SKETCH)) % SKETCH
    return (mix64(low[take] + step.astype(np.uint64), 11) & np.uint64(255)).astype(np.uint8).tobytes()


def paths(s: np.ndarray, runs: int, similarity: float) -> tuple[list[int], list[dict]]:
    """Distinct keys at the first depth, and at the second with their parents."""
    limit = np.uint64(min(2.0**64 - 2048, 2.0**64 / (similarity * len(s))))
    nodes = mix64(np.arange(runs, dtype=np.uint64), 3)
    parent, first = nodes, nodes[:0]
    for depth in range(1, DEPTHS[1] + 1):
        hit = []
        for a, b in slices([len(s)] * len(nodes), 1 << 20):  # bounds the matrix
            rows, cols = np.nonzero(mix64(s[None, :] ^ nodes[a:b, None], depth) < limit)
            hit.append((rows + a, cols))
        if not hit:
            break
        rows, cols = (np.concatenate(x) for x in zip(*hit))
        nodes, parent = mix64(nodes[rows] ^ mix64(s[cols], 5), depth), parent[rows]
        if depth == DEPTHS[0]:
            parent, first = nodes, np.unique(nodes)
    if len(nodes):
        nodes, at = np.unique(nodes, return_index=True)
        deep = [{"parent": p, "key": k} for p, k in zip(parent[at].astype(np.int64).tolist(), nodes.astype(np.int64).tolist())]
    else:
        deep = []
    return first.astype(np.int64).tolist(), deep


_SIGNED = pa.schema([("doc_id", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()), ("size", pa.int64()),
                     ("sketch", pa.binary()), ("short", pa.list_(pa.int64())),
                     ("deep", pa.list_(pa.struct([("parent", pa.int64()), ("key", pa.int64())])))])


def _signed(x: np.ndarray) -> int:
    return int(x.astype(np.int64))


def signatures(docs: DataFrame, runs: int, similarity: float) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names = texts_of(batch), batch.column("doc_id").to_pylist()
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                rows = []
                for d, s in zip(names[a:b], shingle_sets(texts[a:b])):
                    with np.errstate(over="ignore"):
                        rows.append((d, _signed(np.add.reduce(s)), _signed(np.add.reduce(mix64(s, 1))), len(s),
                                     *((sketch(s), *paths(s, runs, similarity)) if len(s) else (b"", [], []))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SIGNED)], schema=_SIGNED)

    return docs.mapInArrow(sign, "doc_id long, sig_a long, sig_b long, size long, sketch binary, short array<long>, deep array<struct<parent:long,key:long>>")


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[dict[str, list]]:
    """Rows of one key after another, from batches sorted by key."""
    held: dict[str, list] | None = None
    for batch in batches:
        cols = batch.to_pydict()
        marks = list(zip(*(cols[k] for k in key)))
        a = 0
        while a < len(marks):
            b = a + 1
            while b < len(marks) and marks[b] == marks[a]:
                b += 1
            part = {c: v[a:b] for c, v in cols.items()}
            if held and tuple(held[k][0] for k in key) == marks[a]:
                held = {c: held[c] + part[c] for c in held}
            else:
                if held:
                    yield held
                held = part
            a = b
    if held:
        yield held


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each place the smallest place it is connected with."""
    root = np.arange(len(linked))
    reach = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(reach, root[None, :], len(linked)).min(axis=1)
        if (new == root).all():
            return root
        root = new


def _brute_force(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each small bucket, by sketch, as edges to a smallest id."""
    for group in _groups(batches, ["key"]):
        ids, place = np.unique(np.array(group["doc_id"]), return_index=True)
        if len(ids) < 2:
            continue
        rows = np.frombuffer(b"".join(group["sketch"][i] for i in place), np.uint8).reshape(len(ids), SKETCH)
        size = np.array([group["size"][i] for i in place])
        alike = np.zeros((len(ids), len(ids)), np.int16)
        for k in range(SKETCH):
            alike += rows[:, None, k] == rows[None, :, k]
        near = np.minimum.outer(size, size) >= SIMILARITY * np.maximum.outer(size, size)
        # Small sets have coarse sketches: they are left to the exact step.
        sure = np.minimum.outer(size, size) >= 40
        root = _roots(near & ((alike >= SKETCH_LEAST * SKETCH) | ~sure))
        moved = root != np.arange(len(ids))
        if moved.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["a", "b"])


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Edges (a, b) that join all sets which share a bucket and look alike.
    ``sets``: doc_id, size, sketch, short, deep; doc_id unique."""
    parts = shuffle_parts(sets.sparkSession)

    def buckets(at: DataFrame) -> DataFrame:
        return stored(at.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).filter("n > 1"), "buckets")

    def inside(at: DataFrame, which: DataFrame) -> DataFrame:
        small = at.join(which.filter(F.col("n") <= BUCKET).select("key").hint("merge"), "key")
        return (small.join(sets.select("doc_id", "size", "sketch").hint("merge"), "doc_id")
                .repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_brute_force, "a long, b long"))

    short = sets.select("doc_id", F.explode("short").alias("key"))
    first = buckets(short)
    large = first.filter(F.col("n") > BUCKET).select(F.col("key").alias("parent"))
    # The deeper buckets are counted before any row is joined: a path that no other set
    # takes, as most do, goes no further.
    paths = sets.select("doc_id", F.explode("deep").alias("d")).select("doc_id", "d.*")
    second = (paths.groupBy("parent", "key").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).filter("n > 1")
              .join(large, "parent", "left_semi"))
    second = stored(second.select("key", "n", "least"), "buckets")
    deep = paths.select("doc_id", "key")
    whole = deep.join(second.filter(F.col("n") > BUCKET), "key").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    return inside(short, first).unionAll(inside(deep, second)).unionAll(whole)


def _compare(similarity: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "i", "j"]):
            ids, block = np.array(group["doc_id"]), np.array(group["block"])
            sets = [np.frombuffer(x, np.uint64) for x in group["tokens"]]
            size = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), size)
            tokens, where, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            shared = n[where] > 1  # a token of one set only adds nothing
            column = (np.cumsum(n > 1) - 1)[where[shared]]
            owner = owner[shared]
            both = np.zeros((len(sets), len(sets)), np.float32)
            order = np.argsort(column, kind="stable")
            column, owner = column[order], owner[order]
            for a in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
                x, y = np.searchsorted(column, (a, a + 4096))
                hot = np.zeros((len(sets), 4096), np.float32)
                hot[owner[x:y], column[x:y] - a] = 1
                both += hot @ hot.T
            union = size[:, None] + size[None, :] - both
            linked = (both >= similarity * union) & ~np.eye(len(sets), dtype=bool)
            if group["i"][0] != group["j"][0]:
                linked &= block[:, None] != block[None, :]
            order = np.argsort(ids)
            root = ids[order][_roots(linked[np.ix_(order, order)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[order]), pa.array(root), pa.array(linked.sum(axis=1)[order])], names=["a", "b", "links"])
    return compare


def exact_links(docs: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """``groups``: doc_id, root. Rows (a, b, links): a's links found in one pair
    of blocks, and the smallest id they connect it with."""
    parts = shuffle_parts(docs.sparkSession)
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = groups.join(sizes, "root").select("doc_id", "root", "blocks", F.pmod(F.hash("doc_id"), "blocks").alias("block"))
    # Merge joins here and below: one plan at every size, none with a broadcast
    # that small inputs alone would take.
    texts = docs.join(members.hint("merge"), "doc_id")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            names = ["doc_id", "root", "blocks", "block"]
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                sets = pa.array([s.tobytes() for s in shingle_sets(texts[a:b])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in names), sets], names=[*names, "tokens"])

    sets = texts.mapInArrow(tokens, "doc_id long, root long, blocks int, block int, tokens binary")
    dealt = (sets.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"), "block", "doc_id", "tokens"))
    return (dealt.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
            .mapInArrow(_compare(similarity), "a long, b long, links long"))


def classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id it is connected
    with through links and equal sets), rep (smallest doc_id with its set),
    n_shingles, n_links (other sets within ``similarity`` of its own), n_copies
    (documents with its set, itself included).

    Null texts count as empty; a document without words is alone in its class. A
    doc_id on several rows is one document, with the smallest text; rows without
    a doc_id are left out. Empty tables give no rows; other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter("doc_id is not null")
    signed = stored(signatures(rows, runs_for(recall, DEPTHS[1]), similarity), "signatures")
    # Repeated ids: one set each; here and below ids are compared, not texts.
    one = signed.groupBy("doc_id").agg(F.min(F.struct("size", "sig_a", "sig_b")).alias("s")).select("doc_id", "s.*")
    reps = one.filter("size > 0").groupBy("sig_a", "sig_b", "size").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"))
    reps = stored(reps, "reps")
    sets = stored(signed.join(reps.select(F.col("rep").alias("doc_id"), "sig_a", "sig_b", "size").hint("merge"), ["doc_id", "sig_a", "sig_b", "size"])
                  .select("doc_id", "size", "sketch", "short", "deep").dropDuplicates(["doc_id"]), "sets")
    groups = stored(components(candidate_edges(sets)).withColumnRenamed("node", "doc_id"), "groups")
    found = stored(exact_links(rows, groups, similarity), "links")
    root = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("n_links"))
    known = (reps.join(root.select(F.col("node").alias("rep"), "root"), "rep", "left").join(links, "rep", "left")
             .select("sig_a", "sig_b", "size", "rep", "n_copies", F.coalesce("root", "rep").alias("class_id"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return one.join(known, ["sig_a", "sig_b", "size"], "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("rep", "doc_id").alias("rep"),
        F.col("size").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))
