"""64-bit hashes of words and word shingles over flat arrays; the same in every process."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
#: Bytes whose words are hashed at a time; a longer word is hashed alone.
BLOCK = 1 << 19

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def odd(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(n, dtype=U) + U(seed << 20)) | U(1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, _BASE, U)]))


_POWERS = _powers(256)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of texts whose words are parted by one space, and the number of words of each text.

    A word's hash is a polynomial of its bytes, so the same word has the same hash in any text.
    Words are taken in blocks: what is held beside the texts does not grow with a text's length.
    """
    counts = np.array([t.count(" ") + 1 if t else 0 for t in texts], np.int64)
    flat = np.frombuffer((" ".join([t for t in texts if t]) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    if not counts.sum():
        return np.zeros(0, U), counts
    ends = np.flatnonzero(flat == 32)
    out = np.empty(len(ends), U)
    at = begin = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, begin + BLOCK)))
        last = int(ends[stop - 1]) + 1
        here = ends[at:stop] - begin
        starts = np.concatenate([[0], here[:-1] + 1])
        sizes = here + 1 - starts
        longest = int(sizes.max())
        power = _POWERS if longest <= len(_POWERS) else _powers(longest)
        value = flat[begin:last].astype(U) + U(1)
        value *= power[np.arange(last - begin) - np.repeat(starts, sizes)]
        value[here] = 0
        out[at:stop] = np.add.reduceat(value, starts)
        at, begin = stop, last
    return mix(out), counts


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all runs of ``size`` words; of all the words, where there are fewer."""
    n = min(size, len(words))
    if not n:
        return words
    by = odd(size, 11)
    total = words[: len(words) - n + 1] * by[0]
    for j in range(1, n):
        total = total + words[j : len(words) - n + 1 + j] * by[j]
    return mix(total + U(n))
