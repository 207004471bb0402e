"""Induced suffix sorting of one shard, in batches, with queues that go to disk.

Suffixes are taken bucket by bucket (first byte). A queue per byte holds the
suffixes that smaller ones have induced, in order; a bucket's whole queue is popped
at once and induces the next ones, so every step works on arrays. A queue longer than
``QUEUE_ROWS`` is written to the task's scratch folder and read back when its bucket
comes. The order of the leftmost-smaller positions, which starts the induction, comes
from one induction over their substrings, naming them, and sorting the much shorter
string of names.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

from quill.llm.common import mix64
from quill.llm.ngram_join import powers

QUEUE_ROWS = 4_000_000
SEPARATOR = 0


class Queue:
    """Arrays in order of arrival; the oldest lie on disk once there are many."""

    def __init__(self, folder: str, name: str):
        self.parts: list = []
        self.rows = 0
        self.path = os.path.join(folder, name)

    def push(self, a: np.ndarray) -> None:
        if len(a):
            self.parts.append(a)
            self.rows += len(a)
            if self.rows > QUEUE_ROWS:
                with open(self.path, "ab") as f:
                    for p in self.parts:
                        f.write(p.tobytes())
                self.parts, self.rows = [], 0

    def pop_all(self) -> np.ndarray:
        old = []
        if os.path.exists(self.path):
            old = [np.fromfile(self.path, np.int64)]
            os.remove(self.path)
        out, self.parts, self.rows = old + self.parts, [], 0
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def _spread(queues: list[Queue], chars: np.ndarray, at: np.ndarray) -> None:
    """Each position to its byte's queue, in order."""
    order = np.argsort(chars, kind="stable")
    chars, at = chars[order], at[order]
    cuts = np.flatnonzero(np.diff(chars, prepend=-1, append=999))
    for a, b in zip(cuts, cuts[1:]):
        queues[chars[a]].push(at[a:b])


def _induce(t: np.ndarray, starts: np.ndarray, folder: str) -> np.ndarray:
    """The suffix order that sorted ``starts`` (leftmost-smaller) induce."""
    size = int(t.max()) + 1
    seeds = [starts[t[starts] == c] for c in range(size)]
    longer = [Queue(folder, f"l{c}") for c in range(size)]
    kept: list[np.ndarray] = []
    for c in range(size):
        done = []
        batch = longer[c].pop_all()
        for turn in range(1 << 62):
            if not len(batch):
                break
            done.append(batch)
            before = batch[batch > 0] - 1
            d = t[before]
            _spread(longer, d[d > c], before[d > c])
            batch = before[d == c]
        kept.append(np.concatenate(done) if done else np.zeros(0, np.int64))
        before = seeds[c][seeds[c] > 0] - 1
        d = t[before]
        _spread(longer, d[d > c], before[d > c])
    smaller = [Queue(folder, f"s{c}") for c in range(size)]
    out: list[np.ndarray] = []
    for c in range(size - 1, -1, -1):
        done = []
        batch = smaller[c].pop_all()
        while len(batch):
            done.append(batch)
            before = batch[batch > 0] - 1
            d = t[before]
            _spread(smaller, d[d < c], before[d < c])
            batch = before[d == c]
        below = kept[c][::-1]
        before = below[below > 0] - 1
        d = t[before]
        _spread(smaller, d[d < c], before[d < c])
        if c == SEPARATOR:  # separators are smaller than all and induced by none
            done = [seeds[c][::-1]]
        out += [*done, below]
    return np.concatenate(out)[::-1]


def _order_of(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names by doubling: ranks of 1, 2, 4, ... names."""
    rank, n, step = names.astype(np.int64), len(names), 1
    while True:
        nxt = np.full(n, -1, np.int64)
        nxt[:max(0, n - step)] = rank[step:]
        key = rank * (n + 2) + nxt + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]] - 1) != 0) - 1
        if new.max() == n - 1 or step >= n:
            return order
        rank, step = new, 2 * step


def suffix_order(t: np.ndarray) -> np.ndarray:
    """Suffix array of ``t`` (int16; bytes are 1 to 256, ``SEPARATOR`` ends each text
    and the whole)."""
    n = len(t)
    # A suffix is smaller (S) if its next different byte is larger.
    change = np.flatnonzero(t[:-1] != t[1:])
    kind = np.zeros(n, bool)
    runs = np.diff(np.concatenate([[-1], change]))
    kind[:change[-1] + 1 if len(change) else 0] = np.repeat(t[change] < t[change + 1], runs)
    kind[t == SEPARATOR] = True
    starts = np.flatnonzero(kind[1:] & ~kind[:-1]) + 1
    separators = np.flatnonzero(t == SEPARATOR)
    starts = np.union1d(starts, separators)
    with tempfile.TemporaryDirectory() as folder:
        first = _induce(t, starts[np.argsort(t[starts], kind="stable")], folder)
        is_start = np.zeros(n, bool)
        is_start[starts] = True
        by_substring = first[is_start[first]]
        # Name equal substrings alike: from one start to the next, by hash.
        ends = np.minimum(np.concatenate([starts[1:], [n - 1]]) + 1, n)
        with np.errstate(over="ignore"):
            power, back = powers(n + 1)
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(t) * power[:n])])
            value = np.zeros(n, np.uint64)
            value[starts] = mix64((total[ends] - total[starts]) * back[starts]) + (ends - starts).astype(np.uint64)
        v = value[by_substring]
        name = np.zeros(n, np.int64)
        name[by_substring] = np.cumsum(np.concatenate([[True], v[1:] != v[:-1]])) - 1
        names = name[starts]
        if names.max() + 1 == len(starts):
            order = np.argsort(names)
        else:
            order = _order_of(names)
        return _induce(t, starts[order], folder)


def repeated(texts: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each text, which of its ``length``-byte strings also start elsewhere in
    the shard: those whose suffix shares that many bytes with a neighbour in
    suffix order, by hash. Suffixes that end before are shorter than any such string."""
    t = np.concatenate([x for b in texts for x in (b.astype(np.int16) + 1, np.zeros(1, np.int16))])
    sa = suffix_order(t)
    with np.errstate(over="ignore"):
        power, back = powers(len(t) + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(t) * power[:len(t)])])

        ends = np.flatnonzero(t == SEPARATOR)
        room = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(t)) >= length
        at = np.flatnonzero(room[sa[:-1]] & room[sa[1:]])
        a, b = sa[at], sa[at + 1]
        full = (total[a + length] - total[a]) * back[a] == (total[b + length] - total[b]) * back[b]
    hit = np.zeros(len(t), bool)
    hit[a[full]] = True
    hit[b[full]] = True
    cuts = np.concatenate([[0], ends + 1])
    return [hit[x:y - 1] for x, y in zip(cuts, cuts[1:])]
