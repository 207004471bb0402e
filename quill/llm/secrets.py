"""Secret scans: three fixed patterns and a character convolutional network.

The patterns' findings always stay. Every other candidate (a run of six or more
token characters, as short as the shortest value the patterns take) is judged by a
small convolutional network over its characters and the text around it, written in
numpy: an embedding, one convolution, max pooling, a logistic output. A character of
the candidate and the same one beside it have codes of their own. A window holds the
candidate and 16 characters on both sides; along a longer candidate windows follow
one another to its end, and the highest output counts.

The network is trained on the patterns' own findings against runs of ordinary kinds
(words of one case, short numbers, and what joins them: names, paths, dates), never
against other candidates; in half of the training windows the surrounding text is
masked, so that a bare secret is known by its characters. On a held-back part the
output is calibrated and the threshold set: the highest one that keeps ``RECALL`` of
the labelled findings.

Training reads every document and uses all of their labelled windows, equal ones as one
with its number; the rarer label weighs half as much as the other, at least. The windows are dealt by hash into shards of
about ``SHARD``. In each round every shard trains a copy of the network on all its
windows, and the copies are averaged; calibration counts the outputs of all held-back
windows. Nothing but the network and these counts passes the driver.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.llm.common import PART as ROWS
from quill.llm.common import mix64, stored, text_parts

# Fixed patterns and lengths; letters of the keywords in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "network")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
FOREIGN = re.compile(r"(?<!\S)(?=\S{6})(?=[\x00-\x08\x0e-\x1b!-\x7f]*+[^\x00-\x7f\s])\S+")  # runs that are not all ASCII
PART = re.compile(r"[^\W_]+")
# The ASCII runs that are ``ordinary``, in one search of a text.
ORDINARY = re.compile(r"(?<!\S)(?=\S{6})(?:(?:[^\w\s]|_)*+(?:[0-9]{1,4}|[A-Za-z][a-z]{0,19}|[A-Z]{1,20})(?![A-Za-z0-9]))*+(?:[^\w\s]|_)*+(?!\S)")
SHARD = 8192  # windows of a shard, about
ROUNDS, PASSES = 6, 12  # rounds of averaging; passes over the windows, if there is one shard only
LEAST = 20  # windows of each label to train on
PLACES = 40  # binary places of averaged parameters: whole numbers add up the same in any order
GRID, FAR = 1000, 50  # steps of 1 in the counted outputs, and the largest
RECALL = 0.99
BEFORE, WIDTH = 16, 64
STEP = WIDTH - 2 * BEFORE  # from one window of a long candidate to the next
MASKED = 0.5
_OTHER, _BLANK, _BESIDE = 96, 97, 98

Span = tuple[int, int, int]  # start, place of the kind, end


def pattern_spans(text: str) -> list[Span]:
    """The patterns' findings by start, then kind; code points, end exclusive."""
    # Every match holds one of these marks.
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST] if ":" in text or "=" in text else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST] if "AKIA" in text else []
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Runs the patterns left, that don't touch one of their findings."""
    found = [m.span() for m in CANDIDATE.finditer(text)]
    if not taken:
        return found
    covered = np.zeros(len(text) + 1, np.int64)
    for s, _, e in taken:
        covered[s + 1:e + 1] = 1
    covered = np.cumsum(covered)
    return [(s, e) for s, e in found if covered[s] == covered[e]]


def ordinary(run: str) -> bool:
    """Words of one case (or with a capital) and short numbers only."""
    if run.isalpha():  # one word
        return len(run) <= 20 and (run[1:].islower() or run.isupper() or len(run) == 1)
    return all(len(p) <= 4 if p.isdigit() else len(p) <= 20 and p.isalpha() and (p[1:].islower() or p.isupper() or len(p) == 1) for p in PART.findall(run))


def ordinary_runs(text: str) -> np.ndarray:
    """Start and end of the text's ordinary runs."""
    found = [m.span() for m in ORDINARY.finditer(text)]
    if not text.isascii():  # what ``ORDINARY`` finds of other runs is ordinary too
        found = sorted({*found, *(m.span() for m in FOREIGN.finditer(text) if ordinary(m[0]))})
    return np.array(found, np.int64).reshape(-1, 2)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def window(text: str, start: int, end: int, masked: bool = False) -> list[int]:
    """Codes of the candidate's first window."""
    row = windows(text, [(start, end)])[0][0]
    return [int(c) if c < _BLANK or not masked else _BLANK for c in row]


def windows(text: str, runs: list[tuple[int, int]], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all windows of the runs, and the place of each window's run. Runs of at
    most ``width`` - 2 ``BEFORE`` characters need no more than ``width`` codes."""
    return _cut(_laid([text])[0], np.array(runs, np.int64).reshape(-1, 2) + BEFORE, width)


def _laid(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the texts one after another, with blanks around each, and where each starts."""
    at = BEFORE + np.concatenate([[0], np.cumsum([len(t) + BEFORE + WIDTH for t in texts])])
    codes = np.full(at[-1], _BLANK, np.uint8)
    for t, a in zip(texts, at.tolist()):
        points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes[a:a + len(t)] = np.where((points >= 32) & (points <= 126), points - 32, _OTHER)
    return codes, at[:-1]


def _cut(codes: np.ndarray, runs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``windows``, for places in ``codes``."""
    start, end = runs.T
    many = 1 + np.maximum(0, -((start + WIDTH - 2 * BEFORE - end) // STEP))
    run = np.repeat(np.arange(len(runs)), many)
    at = start[run] + STEP * (np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many))
    x = np.lib.stride_tricks.sliding_window_view(codes, width)[at - BEFORE]
    # Where the run starts and ends in its window; further than the window is all the same.
    first = np.maximum(start[run] - at + BEFORE, -BEFORE).astype(np.int16)[:, None]
    last = np.minimum(end[run] - at + BEFORE, WIDTH).astype(np.int16)[:, None]
    place = np.arange(width, dtype=np.int16)
    x += np.uint8(_BESIDE) * (((place < first) | (place >= last)) & (x != _BLANK))
    x[(place < first - BEFORE) | (place >= last + BEFORE)] = _BLANK
    return x, run


@dataclass
class Network:
    """Embedding (195 codes), convolution, max pooling, logistic output."""

    emb: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    gain: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0

    @classmethod
    def fresh(cls, rng: np.random.Generator, dim: int = 8, taps: int = 5, filters: int = 24) -> Network:
        return cls(rng.normal(0, 0.3, (_BESIDE + _BLANK, dim)), rng.normal(0, 0.2, (taps * dim, filters)), np.zeros(filters), np.zeros(filters + 1))

    def forward(self, x: np.ndarray):
        taps = len(self.conv) // self.emb.shape[1]
        e = self.emb[x]
        cols = np.concatenate([e[:, k:x.shape[1] - taps + 1 + k] for k in range(taps)], axis=2)
        act = cols @ self.conv + self.bias
        top = act.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(act, top[:, None], 1)[:, 0], 0)
        return cols, top, pooled, pooled @ self.out[1:] + self.out[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.scores(x[a:a + 512]) for a in range(0, len(x), 512)]) if len(x) else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.gain * z + self.shift, -50, 50)))

    def tables(self) -> list[np.ndarray]:
        """What each pair of neighbouring codes (the last tap: each code) adds to the
        convolution, so that a place costs a few lookups."""
        if "_tables" not in self.__dict__:
            dim = self.emb.shape[1]
            taps = [(self.emb @ self.conv[k:k + dim]).astype(np.float32) for k in range(0, len(self.conv), dim)]
            self.__dict__["_tables"] = [(taps[k][:, None] + taps[k + 1][None]).reshape(-1, taps[k].shape[1]) if k + 1 < len(taps) else taps[k] for k in range(0, len(taps), 2)]
        return self.__dict__["_tables"]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The raw output as in ``forward``, in single precision, from windows
        without the blanks that all of them end with (but one convolution of them)."""
        taps = len(self.conv) // self.emb.shape[1]
        used = np.flatnonzero((x != _BLANK).any(axis=0))
        width = min(x.shape[1], (int(used[-1]) + 1 if len(used) else 0) + taps)
        # Place by place, so that what is added and compared stays in the processor's cache.
        codes = x[:, :width].T.astype(np.intp, order="C")
        pairs = codes[:-1] * len(self.emb) + codes[1:]
        first, *others = [(table, (pairs if k + 1 < taps else codes)[k:]) for k, table in zip(range(0, taps, 2), self.tables())]
        top, act, more = (np.empty((len(x), self.conv.shape[1]), np.float32) for _ in range(3))
        for place in range(width - taps + 1):
            to = act if place else top
            np.take(first[0], first[1][place], axis=0, out=to, mode="clip")
            for table, at in others:
                np.add(to, np.take(table, at[place], axis=0, out=more, mode="clip"), out=to)
            if place:
                np.maximum(top, act, out=top)
        return np.maximum(top + self.bias, 0) @ self.out[1:] + self.out[0]

    def train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, rounds: int = PASSES, rate: float = 5e-3,
              weight: np.ndarray | None = None) -> None:
        weight = np.ones(len(x)) if weight is None else weight
        self.__dict__.pop("_tables", None)
        params = [self.emb, self.conv, self.bias, self.out]
        first, second, t = [p * 0 for p in params], [p * 0 for p in params], 0
        dim = self.emb.shape[1]
        taps = np.arange(len(self.conv) // dim)[:, None, None]
        for _ in range(rounds):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 64):
                at = order[a:a + 64]
                cols, top, pooled, z = self.forward(x[at])
                dz = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[at]) * weight[at] / weight[at].sum()
                g_out = np.concatenate([[dz.sum()], pooled.T @ dz])
                d_pool = dz[:, None] * self.out[1:] * (pooled > 0)
                picked = cols[np.arange(len(at))[:, None], top]  # rows, filters, taps * dim
                g_conv = np.einsum("nf,nfk->kf", d_pool, picked)
                d_cols = d_pool[:, :, None] * self.conv.T[None]
                codes = x[at[:, None], top + taps]  # taps, rows, filters
                g_emb = np.bincount((codes[..., None] * dim + np.arange(dim)).ravel(),
                                    d_cols.reshape(*top.shape, -1, dim).transpose(2, 0, 1, 3).ravel(), self.emb.size).reshape(self.emb.shape)
                t += 1
                for p, g, m, v in zip(params, (g_emb, g_conv, d_pool.sum(axis=0), g_out), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """As ``line``, for windows."""
        z = np.concatenate([self.scores(x[a:a + 256]) for a in range(0, len(x), 256)])
        self.line(z, y, np.ones(len(z)), np.ones(len(z)), recall)

    def line(self, z: np.ndarray, y: np.ndarray, n: np.ndarray, weight: np.ndarray, recall: float) -> None:
        """A logistic line over raw outputs, then the highest threshold that keeps
        ``recall`` of the findings. Output ``z`` came ``n`` times, and weighs ``weight``."""
        w = np.array([1.0, 0.0])
        f = np.column_stack([z, np.ones(len(z))])
        loss = lambda w: weight @ np.logaddexp(0, np.where(y == 1, -1, 1) * (f @ w)) + 5e-3 * ((w - [1, 0]) ** 2).sum()
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(f @ w, -50, 50)))
            h = (f * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ f + 1e-2 * np.eye(2)
            step = np.clip(np.linalg.solve(h, f.T @ (weight * (p - y)) + 1e-2 * (w - [1, 0])), -2, 2)
            while loss(w - step) > loss(w) and abs(step).max() > 1e-9:  # too far
                step /= 2
            w -= step
        self.gain, self.shift = float(max(w[0], 1e-3)), float(w[1])
        own = np.flatnonzero(y == 1)
        own = own[np.argsort(z[own], kind="stable")]
        upto = np.cumsum(n[own])
        least = z[own[np.searchsorted(upto, int((1 - recall) * upto[-1]), side="right")]]
        self.threshold = float(1 / (1 + np.exp(-np.clip(self.gain * least + self.shift, -50, 50))))

    def params(self) -> list[np.ndarray]:
        return [self.emb, self.conv, self.bias, self.out]

    def with_params(self, flat: np.ndarray) -> Network:
        """A network like this of other parameters, given one after another."""
        cuts = np.cumsum([p.size for p in self.params()])[:-1]
        return Network(*(a.reshape(p.shape).copy() for a, p in zip(np.split(flat, cuts), self.params())))


def _windows(text: str) -> list[dict]:
    """Labelled windows of one text: findings, each also at the end of a longer run
    as in a path, and against them runs of ordinary kinds (the longest and as many by
    hash, in number as the text's findings, so that long plain texts don't outweigh them)."""
    spans = pattern_spans(text)
    out = [(1, m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST and not ordinary(m[2])] if spans else []
    out += [(1, s, e) for s, k, e in spans if k]
    plain = ordinary_runs(text)
    if spans:
        covered = np.zeros(len(text) + 1, np.int64)
        for s, _, e in spans:
            covered[s + 1:e + 1] = 1
        covered = np.cumsum(covered)
        plain = plain[covered[plain[:, 0]] == covered[plain[:, 1]]]
    most = 1 + 2 * len(out)
    longest = plain[np.argsort(plain[:, 0] - plain[:, 1], kind="stable")[:most]].tolist()
    mixed = plain[np.argsort(mix64(plain[:, 0] << 32 | plain[:, 1]), kind="stable")]
    lead = "/".join([text[s:e] for s, e in mixed.tolist() if CANDIDATE.fullmatch(text, s, e)][:6]) if out else ""
    ends = [f"{lead}{'/=_-'[zlib.crc32(text[s:e].encode()) % 4]}{text[s:e]}" for _, s, e in out if lead]
    out += [(0, s, e) for s, e in dict.fromkeys(map(tuple, longest + mixed[:most].tolist()))]
    rows = []
    if out:
        x, run = windows(text, [(s, e) for _, s, e in out])
        x = x[np.searchsorted(run, np.arange(len(out)))].astype(np.uint8)  # the first of each
        bare = np.where(x < _BLANK, x, _BLANK).astype(np.uint8)
        for (y, s, e), full, masked in zip(out, x, bare):
            half = not y and int.from_bytes(hashlib.md5(f"{s}:{e}".encode()).digest()[:2], "big") < MASKED * 65536
            rows += [{"y": y, "codes": c.tobytes()} for c in ([masked, full] if y else [masked if half else full])]
    return rows + [{"y": 1, "codes": windows(t, [(0, len(t))])[0][-1].astype(np.uint8).tobytes()} for t in ends]


_LABELLED = pa.schema([("y", pa.int32()), ("codes", pa.binary())])


def training_windows(docs: DataFrame) -> DataFrame:
    """The labelled windows of all documents, stored: y, codes, n (how often it came),
    held (how many of these are kept back from training, a fourth on the whole)."""
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_parts(batch.column("text")):
                rows = [w for t in texts for w in _windows(t)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_LABELLED)

    rows = docs.select("text").mapInArrow(label, "y int, codes binary")
    rows = rows.groupBy("y", "codes").agg(F.count(F.lit(1)).alias("n"))
    return stored(rows.withColumn("held", F.floor((F.col("n") + F.pmod(F.xxhash64("codes"), F.lit(4))) / 4)), "windows")


def _codes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def fit(docs: DataFrame, seed: int = 7) -> Network | None:
    """Train on the findings of all documents; None without both labels."""
    rows = training_windows(docs)
    counts = rows.groupBy("y").agg(F.sum("n").alias("n"), F.sum("held").alias("held"), F.count(F.lit(1)).alias("kinds")).collect()
    total = [sum(r["n"] for r in counts if r["y"] == y) for y in (0, 1)]
    if min(total) < LEAST:
        return None
    if not all(0 < r["held"] < r["n"] for r in counts):  # too few kinds: all are trained on and counted
        trained = held = rows
    else:
        trained, held = (rows.withColumn("n", n).filter("n > 0") for n in (F.col("n") - F.col("held"), F.col("held")))
    balance = np.array([max(1, sum(total) / 3 / t) for t in total])
    # Copies of a window are dealt one by one: what is frequent is known to every shard.
    shards = math.ceil(sum(total) / SHARD)
    many = F.least("n", F.lit(shards))
    dealt = (trained.withColumn("i", F.explode(F.sequence(F.lit(0), many - 1)))
             .select(F.pmod(F.xxhash64("codes", F.lit(seed)) + F.col("i"), F.lit(shards)).cast("int").alias("shard"), "y", "codes",
                     (F.floor(F.col("n") / many) + F.when(F.col("i") < F.col("n") % many, 1).otherwise(0)).alias("n")))
    dealt = stored(dealt, "shards")
    net = Network.fresh(np.random.default_rng(seed))
    for turn in range(ROUNDS if shards > 1 else 1):
        start = dealt.sparkSession.sparkContext.broadcast(net)

        def train(part: pa.Table) -> pa.Table:
            part = part.sort_by([("codes", "ascending"), ("y", "ascending")])
            own, y = start.value.with_params(np.concatenate([p.ravel() for p in start.value.params()])), part["y"].to_numpy()  # noqa: B023
            own.train(_codes(part["codes"]).astype(np.int64), y.astype(float), np.random.default_rng([seed, turn, part["shard"][0].as_py()]),  # noqa: B023
                      PASSES if shards == 1 else 1, weight=part["n"].to_numpy() * balance[y])
            flat = np.concatenate([p.ravel() for p in own.params()])
            return pa.table({"at": pa.array(np.arange(len(flat), dtype=np.int32)), "value": pa.array(np.rint(flat * 2.0**PLACES).astype(np.int64))})

        copies = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(train, "at int, value long")
        sums = copies.groupBy("at").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n")).collect()  # a row a parameter
        net = net.with_params(np.array([r["value"] / r["n"] / 2.0**PLACES for r in sorted(sums, key=lambda r: r["at"])]))
    trained_net = dealt.sparkSession.sparkContext.broadcast(net)

    def outputs(batches):
        for b in batches:
            x = _codes(b.column("codes"))
            z = np.concatenate([trained_net.value.scores(x[a:a + 256]) for a in range(0, len(x), 256)]) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(np.floor(np.clip(z, -FAR, FAR) * GRID).astype(np.int32)), b.column("n")], names=["y", "z", "n"])

    got = held.select("y", "codes", "n").mapInArrow(outputs, "y int, z int, n long").groupBy("y", "z").agg(F.sum("n").alias("n")).orderBy("y", "z").toPandas()  # at most the grid
    y, n = got["y"].to_numpy(), got["n"].to_numpy().astype(float)
    net.line(got["z"].to_numpy() / GRID, y.astype(float), n, n * balance[y], RECALL)
    return net


def find(text: str, net: Network | None) -> tuple[list[Span], list[Span]]:
    """The patterns' findings, and all findings, both by start, then kind."""
    return find_all([text], net)[0]


def find_all(texts: list[str], net: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """As ``find`` for each text; the network judges the candidates of all texts together,
    those of like lengths next to each other."""
    base = [pattern_spans(t) for t in texts]
    if net is None:
        return [(b, b) for b in base]
    found = [candidates(t, b) for t, b in zip(texts, base)]
    more = np.array([c for f in found for c in f], np.int64).reshape(-1, 2)
    codes, at = _laid(texts)
    laid = more + np.repeat(at, [len(f) for f in found])[:, None]
    best, order = np.zeros(len(more)), np.argsort(more[:, 1] - more[:, 0], kind="stable")
    for a in range(0, len(order), 4096):
        some = order[a:a + 4096]
        longest = int(np.ptp(more[some[-1]]))
        # short runs without the blanks behind them but those of one convolution
        x, run = _cut(codes, laid[some], min(WIDTH, 2 * BEFORE + longest + len(net.conv) // net.emb.shape[1]))
        np.maximum.at(best, some[run], net.probability(x))
    kept, cuts = best >= net.threshold, np.concatenate([[0], np.cumsum([len(f) for f in found])]).tolist()
    return [(b, sorted(b + [(s, 3, e) for (s, e), k in zip(f, kept[c:d].tolist()) if k])) if kept[c:d].any() else (b, b)
            for b, f, c, d in zip(base, found, cuts, cuts[1:])]


_SCANNED = pa.schema([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_network", pa.int64())])


def scan(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_network. A null text counts as empty; no finding gives
    the hash of the empty string and an empty list. Other columns are ignored."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for texts in text_parts(batch.column("text")):
                for base, spans in find_all(texts, held.value):
                    kinds = [k for _, k, _ in spans]
                    rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(),
                                 joined(spans), kinds.count(3)))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(zip(*rows), _SCANNED))], names=["doc_id", *_SCANNED.names])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]).add("n_assign", "long").add("n_access", "long").add("n_hex", "long")
    return docs.select("doc_id", "text").mapInArrow(look, schema.add("base_sha256", "string").add("spans", "string").add("n_network", "long"))


def redactor(docs: DataFrame, net: Network | None, mark: str = "[SECRET]"):
    """A column function: text with every finding replaced by ``mark``;
    overlapping findings are replaced as one. A null text stays null."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        out = []
        for a in range(0, len(texts), ROWS):
            part = texts.slice(a, ROWS).to_pylist()
            parts = []
            for t, (_, spans) in zip(part, find_all([t or "" for t in part], held.value)):
                pieces, at = [], 0
                for s, _, e in spans:
                    if s >= at:
                        pieces += [t[at:s], mark]
                    at = max(at, e)
                parts.append("".join([*pieces, t[at:]]) if spans else t)
            out.append(pa.array(parts, pa.string()))
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return redact
