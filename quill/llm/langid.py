"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams of one to ``LONGEST``
characters, counted over all its learned documents; a document's profile is the same of
the document. Their out-of-place distance adds, for each n-gram of the document's
profile, how far its rank is from its rank in the language's, and the profile's length
if it isn't there. The language of least distance is the prediction.

Inside a task n-grams are windows over an array of code points, told apart by a 64-bit key
(a polynomial of the code points). Counts come from one scan that adds up n-grams per task
before the grouped sum; the most frequent of a language are found per hash bucket,
then per language, so a language with most of the documents meets no single task.
Prediction is one scan without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.common import crc_mod, stored, texts_of

#: N-grams of a profile, and characters of an n-gram.
PROFILE = 400
LONGEST = 4
#: Languages a task holds at once; more are compared in further scans.
LANGUAGES = 500
UNKNOWN = "und"
#: Characters counted in one step, and n-grams counted before a task's table starts anew.
STEP = 1 << 19
GRAMS_KEPT = 1_000_000
BUCKETS = 64
#: Base of the keys: any odd number with well-mixed bits.
BASE = np.uint64(0x9E3779B97F4A7C15)
BLANK = 32

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


@cache
def _classes() -> np.ndarray:
    """For each code point 1 if it is a letter, 2 if it is a mark on one, else 0."""
    table = np.zeros(0x110000, np.uint8)
    for first, last in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(first, last)))
        for value, pattern in ((1, r"\p{L}+"), (2, r"\p{M}+")):
            for m in regex.finditer(pattern, every):
                table[first + m.start():first + m.end()] = value
    return table


def framed(text: str) -> np.ndarray:
    """Code points of the text's words in lower case, a blank around each. A word is a run of
    letters and the marks on them. Empty without a letter."""
    text = text.lower()
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = _classes()[codes]
    if (kind == 2).any():
        found = _WORD.findall(text)
        return np.frombuffer(f" {' '.join(found)} ".encode("utf-32-le"), np.uint32) if found else codes[:0]
    letter = kind == 1
    if not letter.any():
        return codes[:0]
    after = np.zeros(len(codes), bool)
    after[1:] = letter[:-1]
    out = np.where(letter, codes, BLANK)[letter | after]
    return np.concatenate([[BLANK], out, [BLANK] * bool(letter[-1])]).astype(np.uint32)


def windows(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, keys) of the n-grams in framed words: no blank inside, not blank alone."""
    key = np.zeros(len(codes) + 1, np.uint64)
    blank = codes == BLANK
    inner = np.ones(len(codes) + 1, bool)
    for n in range(1, LONGEST + 1):
        if len(codes) < n:
            return
        with np.errstate(over="ignore"):
            key = key[:-1] * BASE + codes[n - 1:] + np.uint64(1)
        # From three on, what was the last character is inside; below, blanks can be all there is.
        inner = inner[:-1] & ~blank[n - 2:-1] if n > 2 else inner[:-1]
        at = np.flatnonzero(inner if n > 2 else inner & ~(blank[:len(inner)] & blank[n - 1:]))
        yield n, at, key[at]


class _Grams(dict):
    """The n-gram of each key met so far."""

    def counts(self, codes: np.ndarray) -> Iterator[tuple[str, int]]:
        """Each n-gram in framed words and how often it is there."""
        if len(self) > GRAMS_KEPT:
            self.clear()
        for n, at, key in windows(codes):
            keys, count = np.unique(key, return_counts=True)
            new = np.array([k not in self for k in keys.tolist()], bool)
            if new.any():
                some = np.flatnonzero(np.isin(key, keys[new]))
                found, first = np.unique(key[some], return_index=True)
                text = codes[at[some[first]][:, None] + np.arange(n)].tobytes().decode("utf-32-le")
                self.update(zip(found.tolist(), (text[i:i + n] for i in range(0, len(text), n))))
            yield from zip(map(self.__getitem__, keys.tolist()), count.tolist())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: dict[str, list[np.ndarray]] = {}
    size: Counter = Counter()
    held: dict[str, Counter] = {}
    grams = _Grams()

    def add(lang: str) -> None:
        total = held.setdefault(lang, Counter())
        for gram, n in grams.counts(np.concatenate(texts.pop(lang))):
            total[gram] += n
        del size[lang]

    def flush() -> Iterator[pa.RecordBatch]:
        for lang in list(texts):
            add(lang)
        for lang, total in held.items():
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(total)), pa.array(list(total)), pa.array(list(total.values()), pa.int64())],
                                                 names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
            codes = framed(text)
            texts.setdefault(lang, []).append(codes)
            size[lang] += len(codes) + 1
            if size[lang] > STEP:
                add(lang)
            if size.total() > 16 * STEP or sum(map(len, held.values())) > GRAMS_KEPT:
                yield from flush()
    yield from flush()


def profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """lang, gram, rank (from 1): each language's most frequent n-grams over all rows of
    ``docs`` (lang, text), ties in the order of the n-grams' code points. Rows without a
    language or text teach nothing, and a language without a letter has no profile."""
    counts = (docs.select("lang", "text").filter("lang is not null and text is not null")
              .mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = [F.col("n").desc(), F.col("gram")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS))).orderBy(*order)
    first = counts.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= size).drop("rank")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= size).select("lang", "gram", "rank")


def _key(gram: str) -> int:
    key = 0
    for c in gram:
        key = (key * int(BASE) + ord(c) + 1) % 2**64
    return key


class Model:
    """The profiles of a block of languages, n-gram by n-gram in the order of their keys."""

    def __init__(self, rows: list[tuple[str, str, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        by: dict[int, list[tuple[int, int]]] = {}
        for lang, gram, rank in rows:
            by.setdefault(_key(gram), []).append((number[lang], rank))
        self.keys = np.array(sorted(by), np.uint64)
        own = [by[k] for k in sorted(by)]
        self.starts = np.cumsum([0, *map(len, own)])
        self.owner = np.array([i for v in own for i, _ in v], np.int64)
        self.rank = np.array([r for v in own for _, r in v], np.int64)

    def distances(self, text: str) -> np.ndarray | None:
        """The text's distance to each language, None without a letter."""
        codes = framed(text)
        if not len(codes):
            return None
        keys = np.sort(np.concatenate([k for _, _, k in windows(codes)]))
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.diff(first, append=len(keys))
        # N-grams of the same count share the rank of the first of them.
        rank = len(n) - np.searchsorted(np.sort(n), n, side="right") + 1
        top = rank <= self.size
        ids, rank = keys[first[top]], rank[top]
        far = self.size * len(ids)
        at = np.searchsorted(self.keys, ids)
        known = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == ids)
        at, rank = at[known], rank[known]
        count = self.starts[at + 1] - self.starts[at]
        each = np.arange(count.sum()) + np.repeat(self.starts[at] - (np.cumsum(count) - count), count)
        near = self.size - np.abs(np.repeat(rank, count) - self.rank[each])
        return far - np.bincount(self.owner[each], weights=near, minlength=len(self.langs)).astype(np.int64)


def _blocks(profile: DataFrame, size: int) -> Iterator[Model]:
    """Models of at most ``LANGUAGES`` languages: LANGUAGES x PROFILE n-grams at once on the driver."""
    lo: str | None = None
    while True:
        rest = profile if lo is None else profile.filter(F.col("lang") > lo)
        langs = [r["lang"] for r in rest.select("lang").distinct().orderBy("lang").limit(LANGUAGES).collect()]
        if not langs:
            return
        rows = rest.filter(F.col("lang") <= langs[-1]).collect()
        yield Model([(r["lang"], r["gram"], r["rank"]) for r in rows], size)
        lo = langs[-1]


def predict(docs: DataFrame, profile: DataFrame, size: int = PROFILE) -> DataFrame:
    """``docs`` columns (all but ``text``), lang_pred and score. ``profile`` has lang, gram
    and rank, and is read more than once.

    lang_pred is the language of least distance, ties to the first in code-point order; score
    is the runner-up's distance over the sum of both (0.5: a tie, 1: no runner-up, or
    nothing between document and profile). Without a letter, a text or a profile: ``und``
    and 0. Whole texts are read, long words too; a task's memory grows with its longest text."""
    names = [c for c in docs.columns if c != "text"]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    rows = docs.select(*names, "text", F.lit(None).cast("string").alias("_lang"), F.lit(None).cast("long").alias("_best"), F.lit(None).cast("long").alias("_next"))
    for model in _blocks(profile, size):
        held = docs.sparkSession.sparkContext.broadcast(model)  # at most LANGUAGES x PROFILE n-grams

        def compare(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            model = held.value
            for batch in batches:
                out = []
                for text, *best in zip(texts_of(batch), *(batch.column(c).to_pylist() for c in ("_lang", "_best", "_next"))):
                    d = model.distances(text)
                    if d is not None:
                        order = np.argsort(d, kind="stable")[:2]
                        two = sorted([(int(d[i]), model.langs[i]) for i in order] + [(best[1], best[0])] * (best[1] is not None))
                        runner = min([x for x, _ in two[1:]] + [best[2]] * (best[2] is not None), default=None)
                        best = [two[0][1], two[0][0], runner]
                    out.append(best)
                lang, first, second = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*names, "text")), pa.array(lang, pa.string()),
                                                  pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=[*names, "text", "_lang", "_best", "_next"])

        rows = rows.mapInArrow(compare, f"{head}{', ' * bool(head)}text string, _lang string, _best long, _next long")
    both = F.col("_best") + F.col("_next")
    score = (F.when(F.col("_best").isNull(), 0.0).when(F.col("_next").isNull(), 1.0)
             .when(both == 0, 0.5).otherwise(F.col("_next").cast("double") / both))
    return rows.select(*names, F.coalesce("_lang", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score. Profiles are learned
    from the text and non-null lang of rows whose crc32(doc_id) mod ``folds`` isn't
    ``held_out``; a row without a doc_id is learned from and not held out. A null text
    counts as empty, repeated rows count each, an empty table gives no rows, and other
    columns are ignored."""
    out = F.coalesce(crc_mod(F.col("doc_id"), folds) == held_out, F.lit(False))
    learned = stored(profiles(docs.filter(~out)), "profiles")
    return predict(docs.select("doc_id", out.alias("held_out"), "text"), learned)
