"""Whole texts as arrays of word hashes, and the hashes of their word n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from cartwise.llm.slabs import mixed, run_hashes, slabs, white_words

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of short texts that are hashed at a time; hashing takes about 50 bytes for each.
TOGETHER = 1 << 18


def word_arrays(texts: list[bytes], lower: bool, base: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Yield (text number, hashes of its white-space separated words), every text once and in order."""
    waiting: list[np.ndarray] = []
    number = -1
    for slab, numbers, starts, stops in slabs(texts, together=TOGETHER):
        own = _LOWER[slab] if lower else slab
        first, last = white_words(own)
        hashes = run_hashes(own, first, last) if base is None else run_hashes(own, first, last, base)
        lows, highs = np.searchsorted(first, starts), np.searchsorted(first, stops)
        for n, low, high in zip(numbers.tolist(), lows.tolist(), highs.tolist()):
            if n != number:
                if waiting:
                    yield number, np.concatenate(waiting)
                number, waiting = n, []
            waiting.append(hashes[low:high])
    if waiting:
        yield number, np.concatenate(waiting)


def ngrams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words; of all words if there are fewer, but some."""
    count = min(size, len(words))
    if count == 0:
        return words
    places = len(words) - count + 1
    out = np.full(places, count, dtype=np.uint64)
    for k in range(count):
        out = mixed(out * _STEP + words[k : k + places])
    return out
