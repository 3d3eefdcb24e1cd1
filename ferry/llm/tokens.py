"""Words and shingle hashes of whole texts with numpy, for the operators that work on sets."""

from __future__ import annotations

import numpy as np

# A-Z to a-z, and the bytes that separate words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


# every lower-cased byte as a random number
SCATTERED = mix(LOWER.astype(np.uint64) + ODD)

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _power(kind: str, n: int) -> np.ndarray:
    table = _powers[kind]
    if len(table) < n:
        base = BASE if kind == "up" else INVERSE
        size = max(n, len(table) + len(table) // 4)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        table = _powers[kind] = np.multiply.accumulate(steps)
    return table[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the lower-cased texts, and the text each word belongs to.

    A word's hash is its polynomial over 2^64 (from running sums of byte times power) with its length
    mixed in; two different words agree with a chance of about 2^-60.
    """
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    inside = ~BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    # powers count from the start of the slice, so the table grows with the slice, not the corpus
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(
        SCATTERED[data] * _power("up", len(data)), dtype=np.uint64)))
    hashes = mix((sums[end] - sums[start]) * _power("down", len(data))[start] + (end - start).astype(np.uint64) * ODD)
    sizes = np.array([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(np.cumsum(sizes), start, side="right")


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text; with fewer words, the whole sequence."""
    words, owner = word_hashes(texts)
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    out = []
    if len(words):
        padded = np.concatenate((words, np.zeros(n, dtype=np.uint64)))
        rolled = np.zeros(len(words), dtype=np.uint64)
        for j in range(n):
            rolled = mix(rolled + padded[j:j + len(words)] + np.array([j + 1], dtype=np.uint64) * ODD)
    for i in range(len(texts)):
        c, a = int(count[i]), int(first[i])
        if c >= n:
            out.append(np.unique(rolled[a:a + c - n + 1]))
        elif c:
            h = np.array([c], dtype=np.uint64)
            for j in range(a, a + c):
                h = mix(h + words[j:j + 1] + ODD)
            out.append(h)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
