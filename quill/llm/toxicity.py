"""Toxicity by two class-conditional Kneser-Ney models.

The toxic and the ordinary model share one form: class word counts with absolute
discounts back off to class character n-grams of the word (so an inflected or
misspelt form is judged by its stem), order by order from ``ORDER`` down, and
below order 2 both classes back off to one shared continuation distribution,
counted over the two classes together. An expression seen in neither class, or
only in a rare document, gets nearly the same probability from both.

A word's evidence is the difference of its two log-likelihoods. A document's
features are length-normalised: the mean over the whole document, and the highest
mean over any window of 1 and of 4 words, so that a few words in a long text
still count. A logistic fit on held-back training documents turns them into a
probability.

The classifier is fitted on at most about ``MAX_TRAIN`` labelled documents of
each class, chosen by a hash of the id over all labelled rows, and ``MAX_CALIBRATE``
for the logistic fit. Scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.common import Memo, crc_mod, stored, text_parts

MAX_TRAIN = 4000
MAX_CALIBRATE = 12000
DISCOUNT = 0.75
ORDER = 6
LEAST = 3  # words and n-grams of fewer documents are left to the backoff
WINDOW = 4
LONGEST = 64  # of a longer word only n-grams count, never the word as such
CACHE_WORDS = 300_000
CACHE_GRAMS = 150_000
SPELT = 2000  # words whose n-grams are counted at once
WORD = re.compile(r"\w+")
_COUNTS = pa.schema([("kind", pa.int32()), ("s", pa.string()), ("n0", pa.int64()), ("n1", pa.int64())])


@dataclass
class Model:
    """Probabilities as pairs (ordinary, toxic); those of the dictionaries as one complex
    number, which takes a fourth of a tuple's memory. ``words``: a known word's own
    mass; ``grams``: the next character after its context, for every kept
    n-gram, and ``rest``: the mass a context leaves to the next shorter one, as logarithms."""

    words: dict[str, complex]
    spare: tuple[float, float]
    grams: dict[str, complex]
    rest: dict[str, complex]
    unseen: float
    mean: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0.0, 2.0, 0.0]))

    def __post_init__(self) -> None:
        self.evidence = Memo(self._evidence, CACHE_WORDS, LONGEST)
        self.steps = Memo(self._step, CACHE_GRAMS, ORDER, self.grams)

    def _evidence(self, word: str) -> float:
        p0, p1 = self._spelt(word)
        w = self.words.get(word, 0j)
        # Both sides are mixed in proportion to their size: far below the
        # own mass of a known word the spelling no longer matters.
        return math.log(w.imag + self.spare[1] * p1 + 1e-300) - math.log(w.real + self.spare[0] * p0 + 1e-300)

    def _step(self, gram: str) -> complex:
        """Logarithms of an unknown n-gram's last character after the others, the
        ordinary model's as real part and the toxic one's as imaginary part."""
        if len(gram) == 1:
            return complex(math.log(self.unseen), math.log(self.unseen))
        return self.steps[gram[1:]] + self.rest.get(gram[:-1], 0j)

    def __getstate__(self) -> dict:
        # Without the caches; no word holds a line end.
        state = {k: v for k, v in self.__dict__.items() if k not in ("evidence", "steps")}
        return state | {k: ("\n".join(state[k]), np.array(list(state[k].values()), complex)) for k in ("words", "grams", "rest") if state[k]}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= {k: dict(zip(v[0].split("\n"), v[1].tolist())) if isinstance(v, tuple) and k != "spare" else v for k, v in state.items()}
        self.__post_init__()

    def _spelt(self, word: str) -> tuple[float, float]:
        s = f" {word} "
        grams = [s[:i] for i in range(2, min(ORDER, len(s) + 1))] + [s[i:i + ORDER] for i in range(len(s) - ORDER + 1)]
        both = sum(map(self.steps.__getitem__, grams))
        return math.exp(max(both.real, -600)), math.exp(max(both.imag, -600))


def _grams(word: str) -> Iterator[str]:
    s = f" {word} "
    for i in range(1, len(s)):
        for k in range(min(ORDER - 1, i) + 1):
            yield s[i - k:i + 1]


def _counts(rows: DataFrame) -> DataFrame:
    """kind 0: words, 1: n-grams; s; in how many documents of each class (an
    n-gram: summed over the words that hold it). A document counts a word once,
    so a repeated line adds nothing."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            texts = (t for part in text_parts(batch.column("text")) for t in part)
            for t, y in zip(texts, batch.column("toxic").to_pylist()):
                counts[y].update(set(WORD.findall(t.lower())))
            keys = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_pydict({"kind": [0] * len(keys), "s": keys, "n0": [counts[0][k] for k in keys], "n1": [counts[1][k] for k in keys]}, schema=_COUNTS)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, SPELT) for b in batches for a in range(0, b.num_rows, SPELT)):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for w, *n in zip(*(batch.column(c).to_pylist() for c in ("s", "n0", "n1"))):
                for g in _grams(w):
                    counts[0][g] += n[0]
                    counts[1][g] += n[1]
            keys = list(counts[0])
            yield pa.RecordBatch.from_pydict({"kind": [1] * len(keys), "s": keys, "n0": [counts[0][k] for k in keys], "n1": [counts[1][k] for k in keys]}, schema=_COUNTS)

    schema = "kind int, s string, n0 long, n1 long"
    total = [F.sum("n0").alias("n0"), F.sum("n1").alias("n1")]
    known = stored(rows.select("text", "toxic").mapInArrow(words, schema).groupBy("kind", "s").agg(*total), "words")
    return known.unionAll(known.mapInArrow(spell, schema).groupBy("kind", "s").agg(*total))


def _kneser_ney(counts: DataFrame) -> Model | None:
    counts = stored(counts, "counts")
    sums = counts.filter("kind = 0").agg(F.sum("n0"), F.sum("n1")).first()
    if not sums[0] or not sums[1]:
        return None
    kept = counts.filter(F.col("n0") + F.col("n1") >= LEAST).toPandas()
    total = np.array([float(sums[0]), float(sums[1])])
    w = kept[(kept["kind"] == 0) & (kept["s"].str.len() <= LONGEST)]
    own = np.maximum(w[["n0", "n1"]].to_numpy(float) - DISCOUNT, 0) / total
    words = dict(zip(w["s"], map(tuple, own.tolist())))
    spare = tuple(np.maximum(1 - own.sum(axis=0), 1e-6).tolist())
    g = kept[kept["kind"] == 1]
    by_len: dict[int, list[tuple[str, float, float]]] = {}
    for s, n0, n1 in zip(g["s"], g["n0"], g["n1"]):
        by_len.setdefault(len(s), []).append((s, float(n0), float(n1)))
    # Shared continuation: in how many different characters' company one stands.
    cont = Counter(s[1] for s, _, _ in by_len.get(2, []))
    base = sum(cont.values()) + len(cont) + 1
    unseen = 1.0 / base
    grams: dict[str, tuple[float, float]] = {c: ((n + 1) / base,) * 2 for c, n in cont.items()}
    rest: dict[str, tuple[float, float]] = {}
    for k in range(2, ORDER + 1):
        at: dict[str, list[float]] = {}
        for s, n0, n1 in by_len.get(k, []):
            c = at.setdefault(s[:-1], [0.0, 0.0, 0.0, 0.0])
            c[0] += n0
            c[1] += n1
            c[2] += min(n0, DISCOUNT)
            c[3] += min(n1, DISCOUNT)
        for h, c in at.items():
            rest[h] = tuple(max(c[2 + y] / c[y], 1e-6) if c[y] else 1.0 for y in (0, 1))
        for s, *n in by_len.get(k, []):
            h, lower = s[:-1], grams.get(s[1:], (unseen, unseen))
            grams[s] = tuple((max(n[y] - DISCOUNT, 0) / at[h][y] if at[h][y] else 0.0) + rest[h][y] * lower[y] for y in (0, 1))
    return Model({s: complex(*p) for s, p in words.items()}, spare, _logs(grams), _logs(rest), unseen)


def _logs(pairs: dict[str, tuple[float, float]]) -> dict[str, complex]:
    return {s: complex(math.log(p[0]), math.log(p[1])) for s, p in pairs.items()}


def features(model: Model, text: str) -> tuple[float, float, float]:
    words = WORD.findall(text.lower())
    if not words:
        return 0.0, 0.0, 0.0
    evidence = np.fromiter(map(model.evidence.__getitem__, words), float, len(words))
    sums = np.concatenate([[0.0], np.cumsum(evidence)])
    w = min(WINDOW, len(words))
    return float(evidence.mean()), float(evidence.max()), float(((sums[w:] - sums[:-w]) / WINDOW).max())


def _measured(model: Model, texts: pa.Array) -> np.ndarray:
    """A row of features for each text of a batch."""
    return np.array([features(model, t) for part in text_parts(texts) for t in part]).reshape(-1, 3)


def probability(model: Model, rows: np.ndarray) -> np.ndarray:
    z = np.column_stack([np.ones(len(rows)), (rows - model.mean) / model.scale]) @ model.weights
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample(rows: DataFrame, share: Column) -> DataFrame:
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model | None:
    """Learn from labelled documents whose crc32(doc_id) mod ``folds`` isn't 0:
    the last remainder calibrates, the others train the two models. Labels other
    than 0 and 1 are ignored; an id labelled twice takes the larger label. None
    if either class has no document to learn from."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    fold = crc_mod(F.col("doc_id"), folds)
    known = stored(known.withColumn("fold", fold.cast("int")).filter("fold <> 0"), "labels")
    texts = docs.select(F.col("doc_id"), F.col("text")).filter(F.col("doc_id").isNotNull())
    sizes = {(r["toxic"], r["last"]): r["count"] for r in known.groupBy("toxic", (F.col("fold") == folds - 1).alias("last")).count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, MAX_TRAIN / max(1, sizes.get((1, False), 0)))).otherwise(
        min(1.0, MAX_TRAIN / max(1, sizes.get((0, False), 0))))
    rest = min(1.0, MAX_CALIBRATE / max(1, sizes.get((0, True), 0) + sizes.get((1, True), 0)))
    # The samples are a counted share of at most about MAX_TRAIN ids a class and
    # MAX_CALIBRATE ids, so they go to every task: no text is shuffled.
    train = _sample(known.filter(F.col("fold") < folds - 1), share)
    model = _kneser_ney(_counts(texts.join(F.broadcast(train), "doc_id")))
    if model is None:
        return None
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("mean double, top double, window double")
    def measure(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in np.ascontiguousarray(_measured(held.value, texts).T)], ["mean", "top", "window"])

    rows = (texts.join(F.broadcast(_sample(known.filter(F.col("fold") == folds - 1), F.lit(rest))), "doc_id")
            .select(measure("text").alias("f"), "toxic").select("f.*", "toxic").toPandas())
    x, y = rows[["mean", "top", "window"]].to_numpy(float), rows["toxic"].to_numpy(float)
    if len(rows) < 2 or y.min() == y.max():
        return model  # too few to calibrate
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = _logistic((x - model.mean) / model.scale, y)
    return model


def scorer(docs: DataFrame, model: Model | None):
    """A column function: text to the probability that its label is 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(np.zeros(len(texts)) if held.value is None else probability(held.value, _measured(held.value, texts)))

    return score


def score(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. A null or
    empty text has no evidence and gets the fit's base rate; without both labels
    every score is 0. Rows without a doc_id are scored, not learnt from, and not
    held out. Other columns are ignored."""
    value = scorer(docs, fit(docs, labels, folds))
    rows = docs.select("doc_id", value("text").alias("score"))
    return rows.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"),
                       "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
