"""Languages are learned on the driver in one array of doubles, and little beside it."""

import tracemalloc

import numpy as np

from sessionlake.llm import langid


def test_training_makes_no_further_arrays_of_the_size_of_its_rows():
    draw = np.random.default_rng(3)
    langs = ["en", "fr", "xx"] * 200
    vectors = [np.eye(1, langid.BUCKETS, ord(lang[0]), dtype=np.float32)[0] + draw.random(langid.BUCKETS, np.float32) / 50 for lang in langs]
    raw = [v.tobytes() for v in vectors]
    rows = 8 * len(raw) * (langid.BUCKETS + 1)
    tracemalloc.start()
    try:
        model = langid.train(langid.with_ones(raw), langs)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 1.5 * rows
    assert [model.predict(v)[0] for v in vectors] == langs
