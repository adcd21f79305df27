"""New words of Latin-1 texts go to the tokenizer's model."""

import random

import numpy as np

from sessionlake.llm import words


def test_new_latin_words_go_to_the_model(monkeypatch):
    enc = words.WordEncoder(words.default_tokenizer())
    want = lambda text: np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    draw = random.Random(4)
    texts = ["".join(chr(draw.randrange(256)) for _ in range(draw.randrange(80))) for _ in range(500)] + ["It's ÉTÉ, zqxjvk zqxjvk 12½ ªº\x1c\x85\xa0µ"]
    called = []
    monkeypatch.setattr(enc, "_new", lambda ws, new=enc._new: called.append(ws) or new(ws))
    assert all(enc.encode(t) == want(t) for t in texts) and not called
    for text in ("Ωmega zqxjvk", "e\u0301te"):
        assert enc.encode(text) == want(text)
    assert called
