"""Language-model scores by the marginal over a subword lattice.

The pieces are those of an existing vocabulary file; it is not trained. Their first
weights come from the vocabulary's own scores (ranks, as a power law), and
``ROUNDS`` rounds of expected counts over the training documents' words, each over
all segmentations, adapt them. A word's probability is the sum over every way to
spell it in pieces, by the forward recursion in log space; a piece that opens a
word carries its mark, so pieces never cross words and a document's marginal
probability is the product of its words' and of the end's. Bytes stand for what no
piece spells.

Words are counted by a grouped sum over all documents, so the recursion runs once
per different word: over words of one length together, and for a word of more than
``LONG`` bytes (a text without white space) along it, in time that grows with its
length. The ``FREQUENT`` most frequent words go to every task (a fixed bound: a word of
more than ``FREQUENT_BYTES`` bytes by its digest); the others meet their documents in a
join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import crc_mod, mix64, stored
from quill.llm.tokens import vocabulary_path

FREQUENT = 200_000
FREQUENT_BYTES = 64
ROUNDS = 2
PRIOR = 0.05  # pseudo-counts per piece, dealt by the first weights
RANK_SHIFT = 50.0
BYTE_SHARE = 1e-4
CHUNK = 4096
LONG = 512
STRETCH = 1 << 16  # places of a long word whose pieces are held at once
TABLE_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_READ = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("tokens", pa.int64()), ("known", pa.int64()),
                   ("logc", pa.float64()), ("lp", pa.float64()), ("word", pa.string()), ("k", pa.int64())])


class Pieces:
    """The vocabulary as byte strings (a blank opens a word), with a lookup by
    hash, and the first weights. Id len(strings) is the end of the text."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        strings, weight = [], []
        for i in range(m.get_piece_size()):
            if m.is_control(i) or m.is_unknown(i) or m.is_byte(i):
                continue
            s = m.id_to_piece(i).replace("▁", " ")
            if m.get_score(i) > -1e8 and (s == " " or " " not in s[1:]):
                strings.append(s.encode())
                weight.append(1 / (RANK_SHIFT - m.get_score(i)))
        n = len(strings)
        self.size = n + 257  # pieces, bytes, end
        self.bytes_at, self.end = n, n + 256
        w = np.array(weight) / sum(weight) * (1 - BYTE_SHARE)
        first = np.concatenate([w, np.full(256, BYTE_SHARE / 256), [0.01]])
        self.first = first / first.sum()
        self.longest = max(map(len, strings))
        with np.errstate(over="ignore"):
            h = np.zeros(n, np.uint64)
            begun = set()
            for i, s in enumerate(strings):
                x = 0
                for b in s:
                    x = (x * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
                    begun.add(x)
                h[i] = x
        h = mix64(h)
        order = np.argsort(h)
        self.keys, self.ids = h[order], order
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[h >> np.uint64(64 - TABLE_BITS)] = True
        # What some piece begins with: nothing longer is looked up behind anything else.
        self.begins = np.zeros(1 << TABLE_BITS, bool)
        self.begins[mix64(np.array(sorted(begun), np.uint64)) >> np.uint64(64 - TABLE_BITS)] = True

    def arcs(self, m: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, ids) of every piece in the equally long rows of m."""
        out = []
        length = m.shape[1]
        wide = m.astype(np.uint64) + np.uint64(1)
        every = np.arange(len(m))
        with np.errstate(over="ignore"):
            for i in range(length):
                out.append((i, i + 1, every, self.bytes_at + m[:, i].astype(np.int64)))
                here, h = every, np.zeros(len(m), np.uint64)
                for j in range(i, min(length, i + self.longest)):
                    h = h * _BASE + (wide[:, j] if len(here) == len(every) else wide[here, j])
                    g = mix64(h)
                    place = g >> np.uint64(64 - TABLE_BITS)
                    left = np.flatnonzero(self.begins[place])
                    if not len(left):
                        break
                    if len(left) < len(here):
                        here, h, g, place = here[left], h[left], g[left], place[left]
                    rows = np.flatnonzero(self.table[place])
                    if len(rows):
                        at = np.minimum(np.searchsorted(self.keys, g[rows]), len(self.keys) - 1)
                        same = self.keys[at] == g[rows]
                        if same.any():
                            out.append((i, j + 1, here[rows[same]], self.ids[at[same]]))
        return out


    def along(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, ids) of every piece in one byte string."""
        every = np.arange(len(raw))
        starts, ends, ids = [every], [every + 1], [self.bytes_at + raw.astype(np.int64)]
        wide = raw.astype(np.uint64) + np.uint64(1)
        h = np.zeros(len(raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            for n in range(1, min(self.longest, len(raw)) + 1):
                h = h[:-1] * _BASE + wide[n - 1:]
                g = mix64(h)
                rows = np.flatnonzero(self.table[g >> np.uint64(64 - TABLE_BITS)])
                at = np.minimum(np.searchsorted(self.keys, g[rows]), len(self.keys) - 1)
                same = self.keys[at] == g[rows]
                starts.append(rows[same])
                ends.append(rows[same] + n)
                ids.append(self.ids[at[same]])
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(ids)


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _spelled(words: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words as bytes with the opening blank, and the places of the short and long ones."""
    raw = [b" " + w.encode() for w in words]
    size = np.array([len(r) for r in raw], np.int64)
    return raw, np.flatnonzero(size <= LONG), np.flatnonzero(size > LONG)


def _by_length(raw: list[bytes], which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of equally long words, and their bytes."""
    size = np.array([len(raw[i]) for i in which])
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order], prepend=-1, append=-1))
    for a, b in zip(cuts, cuts[1:]):
        step = max(1, min(CHUNK, (1 << 22) // int(size[order[a]])))
        for x in range(a, b, step):
            at = which[order[x:min(x + step, b)]]
            yield at, np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(len(at), -1)


def _run(p: Pieces, raw: bytes, logp: np.ndarray, backward: bool = False) -> np.ndarray:
    """Log sums over all ways to spell the bytes before each place of a long word
    (``backward``: after it), place by place in stretches. Backward is forward on the
    pieces of the mirrored word."""
    b = np.frombuffer(raw, np.uint8)
    n, reach = len(b), p.longest - 1
    out = [0.0]
    for a in range(0, n, STRETCH):
        z = min(n, a + STRETCH)
        if backward:  # places n - z to n - a
            lo = n - z
            starts, ends, ids = p.along(b[lo:min(n, n - a + reach)])
            starts, ends = n - (ends + lo), n - (starts + lo)
        else:
            lo = max(0, a - reach)
            starts, ends, ids = p.along(b[lo:z])
            starts, ends = starts + lo, ends + lo
        here = np.flatnonzero((ends > a) & (ends <= z))
        here = here[np.argsort(ends[here], kind="stable")]
        first = np.searchsorted(ends[here], np.arange(a + 1, z + 2)).tolist()
        weight, start = logp[ids[here]].tolist(), starts[here].tolist()
        for x, y in zip(first, first[1:]):
            terms = [out[start[k]] + weight[k] for k in range(x, y)]
            most = max(terms)
            out.append(most + math.log(sum(math.exp(t - most) for t in terms)))
    return np.array(out[::-1] if backward else out)


def _forward(m: np.ndarray, arcs: list, logp: np.ndarray) -> np.ndarray:
    alpha = np.full((m.shape[1] + 1, len(m)), -np.inf)
    alpha[0] = 0
    for i, j, rows, ids in arcs:  # by start, so alpha[i] is complete
        alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + logp[ids])
    return alpha


def log_marginals(p: Pieces, words: list[str], logp: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability over all its segmentations."""
    out = np.zeros(len(words))
    raw, short, long = _spelled(words)
    for at, m in _by_length(raw, short):
        out[at] = _forward(m, p.arcs(m), logp)[-1]
    for i in long:
        out[i] = _run(p, raw[i], logp)[-1]
    return out


def expected_counts(p: Pieces, words: list[str], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words."""
    total = np.zeros(p.size)
    raw, short, long = _spelled(words)
    for w in long:
        b = np.frombuffer(raw[w], np.uint8)
        alpha, beta = _run(p, raw[w], logp), _run(p, raw[w], logp, backward=True)
        for a in range(0, len(b), STRETCH):
            z = min(len(b), a + STRETCH)
            i, j, ids = p.along(b[a:z + p.longest - 1])
            own = i < z - a
            i, j, ids = i[own] + a, j[own] + a, ids[own]
            total += np.bincount(ids, np.exp(alpha[i] + logp[ids] + beta[j] - alpha[-1]) * counts[w], p.size)
    for at, m in _by_length(raw, short):
        arcs = p.arcs(m)
        alpha = _forward(m, arcs, logp)
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0
        for i, j, rows, ids in reversed(arcs):
            step = logp[ids] + beta[j, rows]
            use = np.exp(alpha[i, rows] + step - alpha[-1, rows]) * counts[at][rows]
            total += np.bincount(ids, use, p.size)
            beta[i, rows] = np.logaddexp(beta[i, rows], step)
    return total


def _weights(p: Pieces, counts: np.ndarray, ends: float) -> np.ndarray:
    """Log probabilities: expected counts and the prior's pseudo-counts."""
    c = counts + PRIOR * p.size * p.first
    c[p.end] = ends + PRIOR * p.size * p.first[p.end]
    return np.log(c / c.sum())


def _tokens(text: str | None) -> list[bytes]:
    # bytes: only ASCII letters are lowered, only ASCII white space parts words
    return (text or "").encode().lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        train: Counter = Counter()
        rest: Counter = Counter()
        for text, learn in zip(batch.column("text").to_pylist(), batch.column("train").to_pylist()):
            (train if learn else rest).update(_tokens(text))
        words = list(train)
        words += [w for w in rest if w not in train]
        c = [train[w] for w in words]
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()), pa.array(c, pa.int64()),
                                          pa.array([a + rest[w] for a, w in zip(c, words)], pa.int64())], names=["word", "c", "n"])


def _learn(words: DataFrame, path: str, ends: int) -> np.ndarray:
    p = pieces(path)
    logp = np.log(p.first)
    for _ in range(ROUNDS):
        def expect(batches: Iterator[pa.RecordBatch], now: np.ndarray = logp) -> Iterator[pa.RecordBatch]:
            p, total = pieces(path), 0.0
            for batch in batches:
                total = total + expected_counts(p, batch.column("word").to_pylist(), batch.column("c").to_numpy().astype(float), now)
            if not np.isscalar(total):
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "use"])

        found = words.filter("c > 0").select("word", "c").mapInArrow(expect, "id long, use double").groupBy("id").agg(F.sum("use").alias("use")).collect()
        counts = np.zeros(p.size)  # one number per piece of the vocabulary
        for r in found:
            counts[r["id"]] = r["use"]
        logp = _weights(p, counts, ends)
    return logp


def score(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", folds: int = 7, held_fold: int = 2,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (both log10). Null texts count as empty: one end.
    Rows without a doc_id are scored, neither learnt from nor held out. Empty tables
    give no rows, and with no training document every count is 0; other columns are ignored. Repeated
    rows count each, and texts are read whole, without white space too. ``score`` is the probability of the text's
    lower-cased words in their order, whatever the white space between them."""
    spark = docs.sparkSession
    path = vocabulary_path(vocabulary)
    fold = crc_mod(F.col("doc_id"), folds)
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .withColumns({"held_out": F.coalesce(fold == held_fold, F.lit(False)), "train": F.coalesce(fold != held_fold, F.lit(False))}))
    ends = texts.filter("train").count()
    counted = stored(texts.select("text", "train").mapInArrow(_count, "word string, c long, n long")
                     .groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "words")
    sums = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, distinct = sums[0] + ends, sums[1] + (ends > 0)
    logp = _learn(counted, path, ends)
    held_logp = spark.sparkContext.broadcast(logp)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for batch in batches:
            lp = log_marginals(p, batch.column("word").to_pylist(), held_logp.value) / math.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("word", "c", "n")), pa.array(lp)], names=["word", "c", "n", "lp"])

    words = stored(counted.mapInArrow(weigh, "word string, c long, n long, lp double"), "weighed")
    # Words by the logarithm of their count: the cut that keeps FREQUENT of them.
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True)
    cut, room = 1 << 30, FREQUENT
    for r in sizes:
        room -= r["count"]
        if room < 0:
            break
        cut = r["level"]
    frequent = level >= cut
    name = F.when(F.octet_length("word") <= FREQUENT_BYTES, F.col("word").cast("binary")).otherwise(F.unhex(F.md5(F.col("word").cast("binary"))))
    top = words.filter(frequent).select(name.alias("name"), "c", "lp").toArrow()  # FREQUENT names of FREQUENT_BYTES at most
    known = spark.sparkContext.broadcast((
        {w: i for i, w in enumerate(top.column("name").to_pylist())},
        top.column("c").to_numpy(), top.column("lp").to_numpy()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, c, lp = known.value
        logc, some = np.append(np.log10(c + 1.0), 0), np.append(c > 0, False)
        lps = np.append(lp, 0.0)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, rare = [], []
            for doc_id, held, text in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "held_out", "text"))):
                tokens = _tokens(text)
                there = list(map(place.get, tokens))
                if None in there:
                    there = [(place.get(md5(w).digest(), -1) if len(w) > FREQUENT_BYTES else -1) if i is None else i for i, w in zip(there, tokens)]
                at = np.array(there, np.int64)
                rows.append((key, doc_id, held, len(tokens), int(some[at].sum()), float(logc[at].sum()), float(lps[at].sum()), None, 1))
                left = Counter(tokens[i] for i in np.flatnonzero(at < 0))
                rare += [(key, None, None, 0, 0, 0.0, 0.0, w.decode(), k) for w, k in left.items()]
                key += 1
            for a in range(0, len(rows + rare), 200_000):
                part = (rows + rare)[a:a + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*part), _READ)], schema=_READ)

    found = stored(texts.select("doc_id", "held_out", "text").mapInArrow(
        read, "key long, doc_id long, held_out boolean, tokens long, known long, logc double, lp double, word string, k long"), "read")
    rare = found.filter("word is not null").select("key", "word", "k").join(words.filter(~frequent).select("word", "c", F.col("lp").alias("p")), "word")
    sums = rare.groupBy("key").agg(F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known2"),
                                   F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("logc2"), F.sum(F.col("k") * F.col("p")).alias("lp2"))
    end_c, end_lp, size = math.log10(ends + 1), float(logp[-1]) / math.log(10), math.log10(total + distinct + 1)
    out = found.filter("word is null").join(sums, "key", "left")
    n = F.col("tokens") + 1
    return out.select(
        "doc_id", "held_out", n.alias("n_tokens"), (F.col("known") + F.coalesce("known2", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logc") + F.coalesce("logc2", F.lit(0.0)) + end_c - n * size).alias("base_score"),
        (F.col("lp") + F.coalesce("lp2", F.lit(0.0)) + end_lp).alias("score"))
