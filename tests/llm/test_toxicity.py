"""The model and its caches stay small in a task."""

import pickle

from quill.llm import toxicity
from quill.llm.common import Memo
from tests.llm.memory import peak


def test_toxicity_model_is_small_and_survives_the_way_to_a_task():
    n = 30_000
    grams = {f" {i:05d}"[:6]: complex(-1 - i, -2) for i in range(n)}
    model = toxicity.Model({"bad": 0.25 + 0.5j}, (0.5, 0.25), grams, {" 0": -1 - 3j}, 1e-3)
    data = pickle.dumps(model)
    again = pickle.loads(data)
    assert (again.words, again.spare, again.grams, again.rest, again.unseen) == (model.words, model.spare, model.grams, model.rest, model.unseen)
    assert toxicity.features(again, "bad 00001 q") == toxicity.features(model, "bad 00001 q")
    empty = pickle.loads(pickle.dumps(toxicity.Model({}, (1.0, 1.0), {}, {}, 0.5)))
    assert empty.words == empty.grams == empty.rest == {}
    assert peak(lambda: pickle.loads(data)) < 185 * n  # with pairs of numbers as tuples: 201 bytes an n-gram


def test_a_full_memo_keeps_what_is_frequent():
    asked = []
    memo = Memo(lambda k: asked.append(k) or len(k), 8, 5, {"known": 7})
    for i in range(100):
        assert memo["often"] == 5 and memo[str(i)] == len(str(i)) and memo["known"] == 7 and memo["too long"] == 8
        assert len(memo) + len(memo.aside) <= 9
    assert asked.count("often") == 1 and "known" not in asked and asked.count("too long") == 100
