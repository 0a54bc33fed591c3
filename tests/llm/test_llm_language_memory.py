"""Memory of a prediction follows the group of texts, not the batch."""

import tracemalloc

import numpy as np

from tidepool.llm import langid

SAMPLES = {"a": "the quick brown fox jumps over the lazy dog " * 20, "b": "el veloz zorro salta sobre el perro dormido " * 20}


def test_prediction_holds_one_group_at_a_time():
    languages = langid.Languages(SAMPLES)
    languages.classes  # noqa: B018
    texts = ["the lazy brown dog " * 500, "el perro veloz " * 600] * 700
    tracemalloc.start()
    names, scores = languages.predict(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names == ["a", "b"] * 700 and len(scores) == 1400
    assert peak < sum(map(len, texts))  # 13 MB of text; before, more than three times that


def test_groups_change_no_prediction():
    languages = langid.Languages(SAMPLES)
    rng = np.random.default_rng(1)
    words = " ".join(SAMPLES.values()).split() + ["", "123", "жук"]
    texts = [None, "", "7"] + [" ".join(rng.choice(words, n)) for n in rng.integers(0, 400, 200)]
    whole = languages._predict([t or "" for t in texts])
    kept, langid.GROUP = langid.GROUP, 700
    try:
        parts = languages.predict(texts)
    finally:
        langid.GROUP = kept
    assert whole[0] == parts[0] and np.array_equal(whole[1], parts[1])
    assert languages.predict([])[0] == []
