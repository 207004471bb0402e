"""Repeats by suffix order, against all strings."""

import numpy as np

from quill.llm import suffixsort
from tests.llm.memory import peak


def test_repeats_of_a_shard_are_compared_once():
    rng = np.random.default_rng(7)
    own = rng.integers(0, 4, 4000).astype(np.uint8)
    texts = [own[:1500], own[700:3000], rng.integers(0, 4, 399).astype(np.uint8), own[100:499], own[2500:2900], own[2500:2900]] + [rng.integers(0, 256, 5000).astype(np.uint8) for _ in range(40)]
    seen: dict[bytes, int] = {}
    strings = [[t[i:i + 400].tobytes() for i in range(len(t) - 399)] for t in texts]
    for s in (s for of in strings for s in of):
        seen[s] = seen.get(s, 0) + 1
    hits = suffixsort.repeated(texts, 400)
    for t, of, hit in zip(texts, strings, hits):
        assert len(hit) == len(t) and hit[:len(of)].tolist() == [seen[s] > 1 for s in of] and not hit[len(of):].any()
    n = sum(len(t) for t in texts)
    order = suffixsort.suffix_order(np.concatenate([x for t in texts for x in (t.astype(np.int16) + 1, np.zeros(1, np.int16))]))
    real, suffixsort.suffix_order = suffixsort.suffix_order, lambda t: order
    try:
        assert peak(lambda: suffixsort.repeated(texts, 400)) < 80 * n  # halving steps over all places: 92 bytes a byte
    finally:
        suffixsort.suffix_order = real
