"""Sets of hashed word shingles inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words that a task remembers.
REMEMBERED = 100_000
#: Odd 64-bit multipliers; any would do.
MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    with np.errstate(over="ignore"):  # products are modulo 2^64
        x = x ^ (x >> np.uint64(32))
        x = x * MULTIPLIERS[3]
        x = x ^ (x >> np.uint64(29))
        x = x * MULTIPLIERS[0]
        return x ^ (x >> np.uint64(32))


class Shingler:
    """64-bit hashes of the distinct word shingles of texts; words lie between ASCII white space, A-Z are lowered."""

    def __init__(self, width: int):
        self.width, self.seen = width, {}

    def words(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
        seen = self.seen
        try:
            found = [seen[w] for w in words]
        except KeyError:
            if len(seen) > REMEMBERED:
                seen.clear()
            for w in words:
                if w not in seen:
                    seen[w] = xxhash.xxh3_64_intdigest(w)
            found = [seen[w] for w in words]
        return np.array(found, np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; with fewer words than a shingle has, that of the whole sequence."""
        h = self.words(text) if text else np.empty(0, np.uint64)
        if not len(h):
            return h
        n = min(self.width, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = mix(out ^ (h[k : len(h) - n + 1 + k] * MULTIPLIERS[k % 3]))
        return np.unique(out)


_shinglers: dict[int, Shingler] = {}


def shingler(width: int) -> Shingler:
    if width not in _shinglers:
        _shinglers[width] = Shingler(width)
    return _shinglers[width]
