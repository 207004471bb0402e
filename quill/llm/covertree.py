"""Exact top-k by inner product with a dual-tree cover-tree search.

Queries and data are indexed together: both hang under the same top nodes,
``PIVOTS`` centres spread over a bounded sample by farthest-first traversal; each
row joins its nearest centre, whose covering radius is the largest distance of its
rows. Inside a task a block of queries and a block of rows each get a cover tree (every
level halves the radius), and node pairs are visited best first. A pair of nodes
(a, b) can score at most <a, b> + |a| r_b + |b| r_a + r_a r_b; it is pruned when that is
below the worst kth score of the query group, top nodes on the driver's table of
``PIVOTS`` squared bounds, nodes in the tasks. First bounds come from the sample, which
every query is scored against; they are true scores of true rows.

Query blocks meet row blocks by an equi-join on the block pairs that are left, in
blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.common import shuffle_parts, stored

SCALE = 1024
SAMPLE = 2048
PIVOTS = 32
ROWS_BLOCK = 20_000
QUERIES_BLOCK = 2_000
LEAF = 64
EXACT = 2.0**53


@dataclass
class Node:
    rows: np.ndarray
    centre: np.ndarray
    norm: float
    radius: float
    children: list


def cover_tree(x: np.ndarray, rows: np.ndarray) -> Node:
    """Centres at least half a radius apart; each row under its nearest one."""
    centre = x[rows[0]]
    d = np.sqrt(np.maximum(((x[rows] - centre) ** 2).sum(axis=1), 0))
    radius = float(d.max())
    node = Node(rows, centre, float(np.linalg.norm(centre)), radius * (1 + 1e-9), [])
    if len(rows) <= LEAF or radius == 0:
        return node
    near, owner, centres = d.copy(), np.zeros(len(rows), int), 1
    while centres < len(rows) and near.max() > radius / 2:
        if centres >= math.isqrt(len(rows)) + 1:  # too flat to split any finer
            break
        far = int(near.argmax())
        e = np.sqrt(np.maximum(((x[rows] - x[rows[far]]) ** 2).sum(axis=1), 0))
        owner[e < near] = centres
        near = np.minimum(near, e)
        centres += 1
    for c in range(centres):
        part = rows[owner == c]
        if 0 < len(part) < len(rows):
            node.children.append(cover_tree(x, part))
    return node


def _bound(a: Node, b: Node) -> float:
    return float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


def dual_search(queries: np.ndarray, query_rows: np.ndarray, worst: np.ndarray, data: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """For each query its best k of ``data`` that reach its bound ``worst``: scores and ids. A
    query's own row, known by its number, doesn't count."""
    found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in queries]
    worst = worst.copy()

    def base(a: Node, b: Node) -> None:
        s = queries[a.rows] @ data[b.rows].T
        for row, q in zip(s, a.rows):
            at = np.flatnonzero((row >= worst[q]) & (rows[b.rows] != query_rows[q]))
            if len(at):
                old = found[q]
                found[q] = _best(np.concatenate([old[0], row[at]]), np.concatenate([old[1], ids[b.rows[at]]]), k)
                if len(found[q][0]) == k:
                    worst[q] = max(worst[q], found[q][0][-1])

    def visit(a: Node, b: Node, most: float) -> None:
        # Ties count, so a pair goes only if it stays below every kth score.
        if most * (1 + 1e-12) + 1e-6 < worst[a.rows].min():
            return
        if not a.children and not b.children:
            base(a, b)
            return
        if a.children and (not b.children or a.radius >= b.radius):
            pairs = [(_bound(c, b), c, b) for c in a.children]
        else:
            pairs = [(_bound(a, c), a, c) for c in b.children]
        for most, x, y in sorted(pairs, key=lambda p: -p[0]):
            visit(x, y, most)

    if len(queries) and len(data):
        a, b = cover_tree(queries, np.arange(len(queries))), cover_tree(data, np.arange(len(data)))
        visit(a, b, _bound(a, b))
    return found


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """rid (a row's number), vec_id, v (integers as doubles). Left out: null ids, null or empty vectors, and
    vectors with a null or non-finite component."""
    x = F.col(vector_col).cast("array<double>")
    good = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform("x", lambda e: F.floor(e * SCALE).cast("double"))
    wide = F.exists("x", lambda e: F.abs(e) >= 2.0**42)
    # floor() gives a long: beyond that range a double has no fraction left.
    safe = F.when(wide, F.transform("x", lambda e: F.when(F.abs(e) < 2.0**42, F.floor(e * SCALE).cast("double")).otherwise(e * SCALE))).otherwise(whole)
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).filter((F.size("x") > 0) & good)
            .select(F.monotonically_increasing_id().alias("rid"), "vec_id", safe.alias("v")))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def _pivots(x: np.ndarray) -> np.ndarray:
    """Farthest-first centres of the sample."""
    if not len(x):
        return x
    chosen = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < PIVOTS and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)[None, :]
    at = d.argmin(axis=1)
    return at, np.sqrt(((x - pivots[at]) ** 2).sum(axis=1))


def _one_length(data: DataFrame, is_query, k: int) -> DataFrame:
    """Top k among vectors of one length."""
    spark = data.sparkSession
    parts = shuffle_parts(spark)
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id", "rid").limit(SAMPLE).collect()
    sx = np.array([r["v"] for r in sample], float)
    held = spark.sparkContext.broadcast((_pivots(sx), sx, np.array([r["rid"] for r in sample], np.int64)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = held.value[0]
        for batch in batches:
            if batch.num_rows:
                at, d = _nearest(_matrix(batch.column("v")), pivots)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "vec_id", "v")), pa.array(at, pa.int32()), pa.array(d)],
                                                 names=["rid", "vec_id", "v", "pivot", "distance"])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, x, rids = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            score = _matrix(batch.column("v")) @ x.T
            score[batch.column("rid").to_numpy()[:, None] == rids[None, :]] = -np.inf
            worst = np.sort(score, axis=1)[:, -k] if len(rids) >= k else np.full(len(score), -np.inf)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "vec_id", "v", "pivot", "distance")), pa.array(worst)],
                                             names=["rid", "vec_id", "v", "pivot", "distance", "worst"])

    columns = "rid long, vec_id long, v array<double>, pivot int, distance double"
    rows = stored(data.mapInArrow(assign, columns), "rows")
    queries = stored(rows.filter(is_query).mapInArrow(bound, columns + ", worst double"), "queries")
    top = {r["pivot"]: r for r in rows.groupBy("pivot").agg(F.max("distance").alias("radius"), F.count("*").alias("n")).collect()}
    asked = {r["pivot"]: r for r in queries.groupBy("pivot").agg(
        F.max("distance").alias("radius"), F.count("*").alias("n"), F.min("worst").alias("worst")).collect()}
    centres = held.value[0]
    pairs = []
    for q, a in asked.items():
        for d, b in top.items():
            x, y = (Node(np.zeros(0), centres[p], float(np.linalg.norm(centres[p])), r["radius"] * (1 + 1e-9), []) for p, r in ((q, a), (d, b)))
            if _bound(x, y) * (1 + 1e-12) + 1e-6 >= a["worst"]:
                pairs.append((q, d, -(-a["n"] // QUERIES_BLOCK), -(-b["n"] // ROWS_BLOCK)))
    left = F.broadcast(spark.createDataFrame(pairs, "q int, d int, qn int, dn int"))  # PIVOTS squared at most
    salt = F.xxhash64("rid")
    side = lambda df, own, other, n, worst: (
        df.join(left, df["pivot"] == left[own]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        .select("q", "d", (F.pmod(salt, n) if worst is not None else F.col("other")).cast("int").alias("i"),
                (F.col("other") if worst is not None else F.pmod(salt, n)).cast("int").alias("j"),
                "rid", "vec_id", "v", (F.col("worst") if worst is not None else F.lit(None).cast("double")).alias("worst")))
    dealt = side(queries, "q", "dn", F.col("qn"), True).unionAll(side(rows, "d", "qn", F.col("dn"), None))
    keys = ["q", "d", "i", "j"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quill.llm.ngram_join import _groups

        for group in _groups(batches, keys):
            v, ids, rids = np.array(group["v"], float), np.array(group["vec_id"], np.int64), np.array(group["rid"], np.int64)
            worst = np.array([np.nan if w is None else w for w in group["worst"]], float)
            asks = ~np.isnan(worst)
            found = dual_search(v[asks], rids[asks], worst[asks], v[~asks], ids[~asks], rids[~asks], k)
            n = [len(f[0]) for f in found]
            if sum(n):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(rids[asks], n)), pa.array(np.repeat(ids[asks], n)), pa.array(np.concatenate([f[1] for f in found])),
                     pa.array(np.concatenate([f[0] for f in found]).astype(np.int64))], names=["query", "query_id", "vec_id", "score"])

    hits = dealt.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(search, "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Queries: rows whose id is divisible by ``every``; candidates: all rows but
    the query's own. Rows query_id, rank, vec_id, score with the k highest integer
    inner products of floor(1024 x), ties to the smaller id (all, if fewer).

    Vectors null, empty or holding a null or non-finite component take no part. An id on
    several rows is several candidates, and several queries with results of their own;
    only a query's own row is left out. Vectors of different
    length have no inner product: each length is searched by itself. Sums are exact
    while the squared norms stay under 2^53, and an error is raised beyond. Empty tables give no rows; other
    columns are ignored."""
    data = stored(_vectors(vectors, id_col, vector_col), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e)
    lengths = data.groupBy(F.size("v").alias("n")).agg(F.max(norm).alias("norm")).collect()
    if any(r["norm"] >= EXACT for r in lengths):
        raise ValueError("components too large for exact integer scores")
    out = None
    for r in lengths:
        found = _one_length(data.filter(F.size("v") == r["n"]), F.col("vec_id") % every == 0, k)
        out = found if out is None else out.unionAll(found)
    if out is None:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
