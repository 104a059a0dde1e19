"""Words and hashes of word windows, for a block of texts at once."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

#: Odd, so it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_2 = 0xD1342543DE82EF95

#: Upper to lower case for A-Z alone.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Places(dict):
    """Numbers keys from 0 in the order in which they are first looked up."""

    def __missing__(self, key: bytes) -> int:
        self[key] = at = len(self)
        return at


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of anything but space and \\x09-\\x0D, which is how bytes are split."""
    raw = (text or "").encode()
    return (raw.translate(LOWER) if lower else raw).split()


def word_codes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of all texts, and where each text starts (one more at the end)."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(counts)])
    known: dict[bytes, int] = {}
    for words in texts:
        known.update(dict.fromkeys(words))
    for w in known:
        known[w] = xxh3_64_intdigest(w)
    codes = np.fromiter((known[w] for words in texts for w in words), np.uint64, int(starts[-1]))
    return codes, starts


def rolling(codes: np.ndarray, window: int, base: int = BASE) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of the `window` codes from each position on.

    sum(code[i + j] * base**-j) is taken from running sums of code[k] * base**-k, times base**i.
    """
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    down = _powers(inverse, len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * down, dtype=np.uint64)])
    return _mixed((sums[window:] - sums[:n]) * _powers(base, n))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads a difference in any bit over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def whole_windows(starts: np.ndarray, window: int) -> np.ndarray:
    """Which positions start a window that ends within the same text."""
    n = max(0, int(starts[-1]) - window + 1)
    inside = np.ones(n, bool)
    for back in range(1, window):
        at = starts[1:] - back
        inside[at[(at >= 0) & (at < n) & (at >= starts[:-1])]] = False
    return inside
