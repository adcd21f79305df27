"""Short texts are left to tiktoken whole; longer ones and parts go piece by piece."""

import random

from sessionlake.llm import bpe


def test_short_texts_are_matched_by_tiktoken(monkeypatch):
    enc = bpe.PieceEncoder(bpe.default_ranks(), bpe.default_pattern())
    draw = random.Random(5)
    kinds = [" ", "  ", "\n", "\x1c", "'s", "a", "É", "1", "²", "\u0301", "漢", "...", "\U0001f600"]
    texts = ["".join(draw.choice(kinds) for _ in range(draw.randrange(60))) for _ in range(500)]
    want = [enc.encode(enc.match.findall(t)) for t in texts]
    monkeypatch.setattr(enc, "match", None)
    assert [enc.encode_first(t, len(t)) for t in texts] == want


def test_longer_texts_and_parts_are_matched_piece_by_piece():
    enc = bpe.PieceEncoder(bpe.default_ranks(), bpe.default_pattern())
    text = "one  two " * bpe.CHUNK
    assert enc.encode_first(text, len(text)) == enc.bpe.encode_ordinary(text)
    assert enc.bpe.decode(enc.encode_first("one  two three", 5)) == "one  two"
