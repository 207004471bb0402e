"""Steps that must not grow with the input beyond its share: what they hold, and what they do once."""

import math
import re
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quill.functions import callables
from quill.operators import corpus
from quill.operators import embed as E
from quill.operators import search as S


def test_best_holds_small_score_matrices():
    rng = np.random.default_rng(0)
    q, m = rng.normal(size=(6000, 16)), rng.normal(size=(3000, 16))
    q[3], m[5], m[7, 2] = 0, 0, np.nan      # no score
    m[11] = m[10]
    tracemalloc.start()
    best = S._Best(q, 3)
    best.add(m, np.arange(3000), pa.array(np.arange(3000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    got = best.result(pa.array(np.arange(6000)), ["q", "id", "ord", "key", "score"], pa.int64()).to_pandas()
    with np.errstate(all="ignore"):
        cos = np.rint((q[:300] @ m.T) / (np.linalg.norm(q[:300], axis=1)[:, None] * np.linalg.norm(m, axis=1)) * 1e12)
    cos[~np.isfinite(cos)] = -2e12
    for i in range(300):
        want = sorted(range(3000), key=lambda j: (-cos[i, j], j))[:3]
        assert got[got.q == i].sort_values(["key", "ord"], ascending=[False, True], na_position="last").id.tolist() == want


def test_best_of_lengths_beyond_single_precision():
    m = np.array([[1e-160, 0], [0, 1e160], [1, 1], [1e-200, 1e-200]])
    best = S._Best(np.array([[1.0, 0.5]]), 2)
    best.add(m, np.arange(4), pa.array(np.arange(4)))
    plain = S._Best(np.array([[1.0, 0.5]]), 2)
    for i in range(4):
        plain.add(m[i:i + 1], np.array([i]), pa.array([i]))
    names = ["q", "id", "ord", "key", "score"]
    assert best.result(pa.array([0]), names, pa.int64()).equals(plain.result(pa.array([0]), names, pa.int64()))


def test_md5_buckets_are_counted_as_named(spark):
    df = spark.createDataFrame([(0, "a b A b"), (1, ""), (2, None), (3, "ÄÖ x_1, 2 \U0001f600 z"), (4, "b " * 500)], "i int, text string")
    out = E.HashingEmbedder(dim=16).embed(df)
    assert "md5" not in out._jdf.queryExecution().executedPlan().toString()   # each token of a batch is hashed once, not at every place
    ids = df.withColumn("b", E.bucket_ids(F.col("text"), 16)).orderBy("i").collect()
    for r, w in zip(out.orderBy("i").collect(), ids):
        assert r.embedding == np.bincount(w.b or [], minlength=16).tolist()
    assert E.HashingEmbedder(dim=16).embed(df.limit(0)).count() == 0


def test_texts_become_python_objects_in_small_parts():
    class Texts:
        most = 0

        def __init__(self, texts):
            self.texts = texts

        def __len__(self):
            return len(self.texts)

        def slice(self, a, n):
            part = self.texts.slice(a, n)
            Texts.most = max(Texts.most, len(part))
            return part

    texts = [None if i % 7 == 0 else f"t{i}" for i in range(1000)]
    got = callables._in_parts(str.upper, Texts(pa.array(texts)), pa.string())
    assert got.to_pylist() == [t and t.upper() for t in texts] and Texts.most <= 64
    assert callables._in_parts(len, pa.array([], pa.string()), pa.int32()).to_pylist() == []


def test_crawl_takes_links_once(spark, monkeypatch):
    plans, traverse = [], corpus.traverse
    monkeypatch.setattr(corpus, "traverse", lambda edges, *a, **b: (plans.append(edges._jdf.queryExecution().executedPlan().toString()), traverse(edges, *a, **b))[1])
    pages = spark.createDataFrame([(1, "http://x/", '<a href="/a">'), (2, "http://x/a", '<a href="/">'), (3, "http://x/b", "")], "page_id int, url string, html string")
    seeds = spark.createDataFrame([("m", 0, "http://x/")], "module string, seed_pos int, seed_url string")
    assert sorted((r.page_id, r.depth) for r in corpus.crawl(pages, seeds).collect()) == [(1, 0), (2, 1)]
    assert "regexp" not in plans[0] and "FileScan parquet" in plans[0]   # hops read the stored links


def test_crawl_broadcasts_no_links_or_pages(spark, monkeypatch):
    from quill.sources import tables

    plans, stored = {}, corpus.stored

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, label)

    monkeypatch.setattr(corpus, "stored", noted)
    # Built from numbers: far fewer bytes than their texts, as Spark guesses them
    pages = spark.range(1, 40).select(F.col("id").alias("page_id"), F.format_string("http://x/%d", "id").alias("url"),
                                      F.format_string('<a href="/%d"><a href="/%d">', F.col("id") * 2, F.col("id") * 2 + 1).alias("html"))
    seeds = spark.createDataFrame([("m", 0, "http://x/"), ("m", 1, "http://x/1")], "module string, seed_pos int, seed_url string")
    home = spark.range(99, 100).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.lit('<a href="/1">').alias("html"))

    def crawled():
        out = corpus.crawl(pages.unionAll(home), seeds, 3)
        plans["out"] = out._jdf.queryExecution().executedPlan().toString()
        return sorted((r.seed_pos, r.page_id, r.depth) for r in out.collect())

    want = [(0, 1, 1), (0, 2, 2), (0, 3, 2), *((0, i, 3) for i in (4, 5, 6, 7)), (0, 99, 0), (1, 1, 0)]
    assert crawled() == want
    for label in ("links", "out"):   # the seeds and the pages found are, of proven size
        assert "BuildLeft" not in plans[label] and "BuildRight" in plans[label]
    monkeypatch.setattr(tables, "SIDE_BYTES", 0)
    assert crawled() == want
    for label in ("links", "out"):
        assert "SortMergeJoin" in plans[label] and "BroadcastHashJoin" not in plans[label]


def _circle(spark, n, name):
    return spark.range(n).select(F.col("id").alias(name), F.col("id").alias("ordinal"), F.array(F.cos("id"), F.sin("id")).cast("array<float>").alias("embedding"))


def test_rows_are_dealt_to_as_many_blocks_as_cores_ask_for(spark):
    q, s = _circle(spark, 3000, "query_id"), _circle(spark, 50, "chunk_id")
    hits = S.knn_topk(s, q, k=1, broadcast_bytes=0, max_block_bytes=160)   # ten queries at a time
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    tasks = int(re.search(r"RepartitionByExpression .*, (\d+)", plan)[1])
    pairs = S.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert pairs <= tasks <= pairs + math.sqrt(pairs)   # 300 query blocks, once
    for n in (1, 1000, 10**9):
        assert max(S._dealt(n, 256, 100, 1 << 24)[0], 20) == 20 and math.prod(S._dealt(n, 256, 100, 1 << 24)) >= 400
    got = {r.query_id: r.chunk_id for r in hits.collect()}
    assert len(got) == 3000 and all(got[i] == i for i in range(50))


def test_a_search_with_texts_scores_once(spark):
    store = _circle(spark, 50, "chunk_id").withColumn("text", F.concat(F.lit("t"), "chunk_id"))
    out = S.search(store, _circle(spark, 40, "query_id"), k=1)
    assert {r.query_id: r.documents for r in out.collect()} == {i: [f"t{i}"] for i in range(40)}
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("MapInArrow") == 1


def test_spooled_parts_are_read_again_from_memory_or_disk(monkeypatch):
    def part(a, n):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, pa.schema({"x": pa.int64()})) as w:
            w.write_table(pa.table({"x": pa.array(range(a, a + n))}))
        return out.getvalue().to_pybytes()

    for size, on_disk in ((1 << 20, False), (100, True)):
        monkeypatch.setattr(S, "SPOOL_BYTES", size)
        with S._Spool() as spool:
            for a in range(0, 50, 5):
                spool.add(part(a, 5))
            assert spool.file._rolled is on_disk
            for _ in range(2):
                assert [x for t in spool for x in t["x"].to_pylist()] == list(range(50))
            assert [len(t) for t in spool.blocks(12)] == [10] * 5
        assert spool.file.closed
        with S._Spool() as empty:
            assert list(empty) == [] and list(empty.blocks(3)) == []
