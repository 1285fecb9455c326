"""Sampled positions of texts: for every window, the place of its least gram.

Equal windows have their least gram at the same place inside, so that whatever two texts share
meets at a sampled position, and about one position in half a window is sampled.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from fleetwarden.llm.shingles import mix

GRAM = 32  # bytes
BLOCK = 1 << 20  # window starts handled at once: bounds the memory for very long texts

_BASE = 0x9E3779B97F4A7C15
_PLACE = 22  # low bits that hold a place inside a block


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    size = (1 << _PLACE) - 1
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def gram_hashes(flat: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on; fewer than 4 MB of bytes."""
    powers, inverse = _powers()
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * powers[: len(flat)], out=sums[1:])
    n = len(flat) - GRAM + 1
    return mix((sums[GRAM:] - sums[:n]) * inverse[:n])


def _least_place(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of ``width`` values from each place on, the first of equal ones."""
    n = len(values) - width + 1
    # Place in the low bits: the least packed value tells where it is, and ties go to the first.
    packed = (values >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(values), dtype=np.uint64)
    padded = np.full(-(-len(packed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    return (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64)


def sampled(flat: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash): windows of ``length`` bytes that start from first to last have
    their least gram at place. Every window inside one of the texts between ``bounds`` is in one row.
    """
    found: list[tuple[np.ndarray, ...]] = []
    n, start = len(flat), 0
    while start < n:
        stop = min(start + BLOCK, n)
        part = flat[start : min(stop + length - 1, n)]
        if len(part) >= length:
            hashes = gram_hashes(part)
            place = _least_place(hashes, length - GRAM + 1)[: stop - start]
            text = np.searchsorted(bounds, np.arange(start, start + len(place)), "right") - 1
            inside = np.arange(start, start + len(place)) + length <= bounds[text + 1]
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
            first = np.flatnonzero(new & inside)
            if len(first):
                # A run ends before the next begins, or at its text's last window.
                ends = np.append(np.flatnonzero(new)[1:], len(place)) - 1
                ends = ends[np.searchsorted(np.flatnonzero(new), first)]
                last = np.minimum(ends + start, bounds[text[first] + 1] - length)
                found.append((place[first] + start, first + start, last, hashes[place[first]]))
        start = stop
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))
