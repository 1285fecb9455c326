"""Word shingles of texts as 64-bit hashes, computed for many texts at once.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z in lower case. A text's set holds
its distinct shingles of ``WIDTH`` words; with fewer words the whole sequence is its one shingle;
without words it is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from fleetwarden.llm.common import text_bytes

WIDTH = 5
BLOCK = 1 << 18  # bytes hashed at once: bounds the memory, about 50 bytes for each

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER += 1
_BASE = 0x9E3779B97F4A7C15
_STEPS = np.array([pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64) for i in range(WIDTH)], np.uint64)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        factors = np.full(max(n, 1 << 12), _BASE, np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors, dtype=np.uint64)
    return _powers


def _block_words(flat: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, begin) of the words of ``flat``; a word also ends at each of ``breaks``."""
    word = ~_SPACE[flat]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[breaks] = word[breaks]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    inside = np.flatnonzero(word)
    at = np.searchsorted(inside, starts)
    sizes = np.diff(np.append(at, len(inside)))
    place = np.arange(len(inside)) - np.repeat(at, sizes)
    values = _LOWER[flat[inside]] * _power_table(int(sizes.max()))[place]
    return mix(np.add.reduceat(values, at) + sizes.astype(np.uint64)), starts


def word_hashes(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    hashes, begins, start, n = [], [], 0, len(flat)
    while start < n:
        end = min(start + BLOCK, n)
        while end < n and not _SPACE[flat[end]]:  # a block ends before white space
            step = np.flatnonzero(_SPACE[flat[end : end + BLOCK]])
            end = end + int(step[0]) if len(step) else min(end + BLOCK, n)
        low, high = np.searchsorted(bounds[:-1], [start, end])
        h, at = _block_words(flat[start:end], bounds[low:high] - start)
        hashes.append(h)
        begins.append(at + start)
        start = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    begin = np.concatenate(begins)
    return np.concatenate(hashes), np.diff(np.searchsorted(begin, bounds))


def sequence_sets(words: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, from the hashes of its words."""
    total = len(words)
    sums = np.zeros(max(total - WIDTH + 1, 0), np.uint64)
    for i in range(WIDTH if total >= WIDTH else 0):
        sums += words[i : total - WIDTH + 1 + i] * _STEPS[i]
    full = mix(sums)
    ends = np.cumsum(counts)
    for start, m in zip((ends - counts).tolist(), counts.tolist(), strict=True):
        if m >= WIDTH:
            found = np.sort(full[start : start + m - WIDTH + 1])
            if len(found) > 1:
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
            yield found
        elif m:
            yield mix((words[start : start + m] * _STEPS[:m]).sum(keepdims=True) + np.uint64(m))
        else:
            yield words[:0]


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text of an Arrow string column."""
    return sequence_sets(*word_hashes(*text_bytes(column)))
