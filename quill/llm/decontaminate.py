"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits. The benchmark's word seeds
(``MIN_TILE`` words) join the documents' windows: the windows' rolling
Karp-Rabin values are looked up in the seeds. For each document and test that
share a seed, the longest match of unmarked words is marked as a tile, again and
again, until none of ``MIN_TILE`` words is left; passages may stand in any order.
The longest length is found by halving, with the Karp-Rabin values of all unmarked
windows of a length, so words that repeat make no pairs of places. A test is leaked
when tiles cover at least ``coverage`` of its words.

The benchmark is read in blocks of about ``BLOCK_CHARS`` characters; each block
goes to every task, so its size there is bounded, and the documents are read
once for each block.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import mix64
from quill.llm.ngram_join import powers

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_CHARS = 16_000_000
WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


class Tests:
    """One block of the benchmark: words as numbers, and the tests that hold each seed."""

    def __init__(self, items: list[tuple[int, str]]):
        self.words: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        self.seeds: dict[int, list[int]] = defaultdict(list)
        for item_id, text in sorted(items, key=lambda x: (x[0] is None, x)):
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in WORD.findall((text or "").lower())], np.int64)
            for h in np.unique(rolling(ids, min(MIN_TILE, len(ids)) or 1)).tolist():
                self.seeds[h].append(len(self.items))
            self.items.append((item_id, ids))
        self.lengths = sorted({min(MIN_TILE, len(ids)) for _, ids in self.items if len(ids)})
        self.keys = np.array(sorted(self.seeds), np.uint64)


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin values of every n words; n is part of the value."""
    m = len(ids) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = h * _BASE + ids[k:k + m].astype(np.uint64)
        return mix64(h)


class _Side:
    """One side of a comparison: its words' running sums, and what is marked."""

    def __init__(self, ids: np.ndarray):
        self.power, self.back = powers(len(ids) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(ids.astype(np.uint64)) * self.power[:len(ids)])])
        self.marked = bytearray(len(ids))

    def free(self) -> np.ndarray:
        """How many unmarked words begin at each place."""
        n = len(self.marked)
        stop = np.where(np.frombuffer(self.marked, np.uint8) != 0, np.arange(n), n)
        return np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n)

    def values(self, at: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[at + n] - self.sums[at]) * self.back[at]

    def mark(self, at: int, n: int) -> None:
        self.marked[at:at + n] = b"\1" * n


def tile(doc: np.ndarray, test: np.ndarray, least: int) -> tuple[int, int]:
    """Words of ``test`` covered, and tiles: the longest match of unmarked words first, of
    equal ones that of the first place in ``doc``, then in ``test``."""
    a, b = _Side(doc), _Side(test)
    tiles = covered = 0
    most = min(len(doc), len(test))
    while most >= least and covered < len(test):
        # What is unmarked changes between lengths only.
        there, own = a.free(), b.free()

        def matches(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            x, y = np.flatnonzero(there >= n), np.flatnonzero(own >= n)  # noqa: B023
            h, g = a.values(x, n), b.values(y, n)
            common = np.intersect1d(h, g)
            return x[np.isin(h, common)], h[np.isin(h, common)], y[np.isin(g, common)], g[np.isin(g, common)]

        low, high = least - 1, most
        while low < high:
            n = (low + high + 1) // 2
            low, high = (n, high) if len(matches(n)[0]) else (low, n - 1)
        if low < least:
            break
        x, h, y, g = matches(low)
        places: dict[int, list[int]] = defaultdict(list)
        for t, v in zip(y[::-1].tolist(), g[::-1].tolist()):
            places[v].append(t)  # the first place last
        end = 0
        for d, v in zip(x.tolist(), h.tolist()):
            if d < end:
                continue
            left = places[v]
            while left and b.marked.find(1, left[-1], left[-1] + low) >= 0:
                left.pop()
            if left:
                t = left.pop()
                a.mark(d, low)
                b.mark(t, low)
                end, tiles, covered = d + low, tiles + 1, covered + low
        most = low - 1
    return covered, tiles


def leaks(tests: Tests, text: str, coverage: float) -> list[tuple[int | None, int, int, int]]:
    """(item_id, words, covered, tiles) of each test the text leaks."""
    get = tests.words.get
    ids = np.array([get(w, 0) for w in WORD.findall(text.lower())], np.int64)
    hits: dict[int, np.ndarray] = {}
    found: dict[int, list[int]] = defaultdict(list)
    for n in tests.lengths:
        h = rolling(ids, n)
        if not len(h):
            continue
        at = np.minimum(np.searchsorted(tests.keys, h), len(tests.keys) - 1)
        places = np.flatnonzero(tests.keys[at] == h)
        order = places[np.argsort(h[places], kind="stable")]
        cuts = np.flatnonzero(np.diff(h[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            seed = int(h[part[0]])
            hits[seed] = part
            for k in tests.seeds[seed]:
                found[k].append(seed)
    out = []
    for k, seeds in sorted(found.items()):
        item_id, words = tests.items[k]
        least = min(MIN_TILE, len(words))
        # Only words in windows that the test has can be part of a tile; a 0 stands for the rest.
        inside = np.zeros(len(ids) + 1, np.int64)
        for seed in seeds:
            np.add.at(inside, hits[seed], 1)
            np.add.at(inside, hits[seed] + least, -1)
        inside = np.cumsum(inside)[:-1] > 0
        keep = inside | np.concatenate([[False], inside[:-1]])
        # No 0 is in a test; a document's word that no test has is one as well.
        covered, tiles = tile(np.where(inside, ids, 0)[keep], words, least)
        if covered >= coverage * len(words):
            out.append((item_id, len(words), covered, tiles))
    return out


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(chars // BLOCK_CHARS) + 1
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def finder(block: DataFrame, coverage: float = COVERAGE):
    """A column function: text to the leaks of one block of the benchmark."""
    held = block.sparkSession.sparkContext.broadcast(Tests([(r["item_id"], r["text"]) for r in block.collect()]))

    @F.pandas_udf("array<struct<item_id:long,n_words:long,n_covered:long,n_tiles:long>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("item_id", "n_words", "n_covered", "n_tiles"), x)) for x in leaks(held.value, t or "", coverage)]
                          for t in texts])

    return find


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """A row per document and leaked test: doc_id, item_id, n_words, n_covered,
    n_tiles, coverage. Null and empty texts leak nothing, tests without words are
    never leaked; repeated rows give repeated results, repeated tests one; a
    test shorter than ``MIN_TILE`` words must stand whole. Texts are compared whole,
    however long. Other columns are ignored; an empty table on either side gives no rows."""
    out = None
    for block in _blocks(benchmark):
        rows = docs.select("doc_id", F.explode(finder(block, coverage)("text")).alias("x")).select("doc_id", "x.*")
        out = rows if out is None else out.unionAll(rows)
    return out.withColumn("coverage", F.col("n_covered") / F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no test."""
    for block in _blocks(benchmark):
        docs = docs.filter(F.size(finder(block, coverage)("text")) == 0)
    return docs
