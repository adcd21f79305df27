"""Encoding with a public word tokenizer inside tasks."""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Words up to this length are remembered: so many that came twice, and so many that came once of late.
REMEMBERED_CHARS, REMEMBERED_WORDS, RECENT_WORDS = 48, 400_000, 100_000


#: The pre-tokens of the word tokenizer in lowered Latin-1 text, with Latin-1's letters and numerals.
LATIN_PRE_TOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The characters that stand for the bytes of a text in a byte-level vocabulary, and Latin-1's UTF-8 bytes in them.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _PLAIN} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
LATIN_BYTES = {c: "".join(BYTE_CHARS[b] for b in chr(c).encode()) for c in range(256)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text is encoded space by space and line by line;
    a Latin-1 text pre-token by pre-token where the tokenizer lowers and splits as LATIN_PATTERN does. Frequent words
    are remembered; new pre-tokens go to the tokenizer's model as they are, other new words are encoded together, a
    special token between them. The result is that of encoding the text at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark_id, self.mark = special[0] if special else (None, None)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spec = json.loads(self.tokenizer.to_str())
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        splits = [x.get("pattern", {}).get("Regex") for x in steps if x["type"] == "Split"]
        self.latin = kinds == ["NFC", "Replace", "Lowercase"] and splits == [LATIN_PATTERN]
        after = [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in steps[1:]]
        self.model = self.tokenizer.model if self.latin and after == [("ByteLevel", False, False)] else None
        self.known: dict[str, bytes] = {"": b""}
        self.recent: dict[str, bytes] = {}

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _new(self, words: list[str]) -> dict[str, bytes]:
        joined = f"\n{self.mark}\n".join(words)
        if self.mark is None or any(joined.count(m) != (len(words) - 1) * (m == self.mark) for m in self.marks):
            return dict(zip(words, self._each(words), strict=True))
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == self.mark_id).tolist()
        raw = ids.tobytes()
        return {w: raw[4 * a : 4 * b] for w, a, b in zip(words, [0, *(c + 1 for c in cuts)], [*cuts, len(ids)], strict=True)}

    def _new_latin(self, words: list[str]) -> dict[str, bytes]:
        """Of LATIN_PRE_TOKENS: normalising and splitting would leave them as they are."""
        if self.model is None:
            return self._new(words)
        tokens = self.model.tokenize
        return {w: np.array([t.id for t in tokens(w.translate(LATIN_BYTES))], "<u4").tobytes() for w in words}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        words, unseen = None, self._new
        if self.latin and not any(m in text for m in self.marks):
            try:
                text.encode("latin-1")
                words, unseen = LATIN_PRE_TOKENS.findall(text.lower()), self._new_latin
            except UnicodeEncodeError:
                pass
        if words is None:
            words = text.replace("\n", " ").split(" ")
        out = list(map(self.known.get, words))
        if None in out:
            recent = self.recent
            missing = [k for k, x in enumerate(out) if x is None]
            seen = {words[k] for k in missing}
            unknown = [w for w in seen if w not in recent]
            new = unseen(unknown) if unknown else {}
            for k in missing:
                w = words[k]
                out[k] = new[w] if w in new else recent[w]
            if len(self.known) > REMEMBERED_WORDS:
                self.known = {"": b""}
            for w in seen:
                if w not in new:
                    self.known[w] = recent.pop(w)
            if len(recent) > RECENT_WORDS:
                recent.clear()
            recent.update((w, x) for w, x in new.items() if len(w) <= REMEMBERED_CHARS)
        return b"".join(out)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
