"""Texts as byte arrays: whole texts packed into slabs of bounded size for numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = 32
#: Bytes worked on at a time. Longer texts are cut at white space; a run of more bytes without any stays whole.
SLAB_BYTES = 1 << 20
#: Steps in which the tables of powers grow; they are as long as the longest slab so far.
_GROWTH = 1 << 16
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def cut(text: bytes, limit: int = SLAB_BYTES) -> Iterator[bytes]:
    """Pieces of at most ``limit`` bytes, cut after white space; a longer one only up to the first white space it has."""
    own, start = np.frombuffer(text, dtype=np.uint8), 0
    while len(text) - start > limit:
        white = np.flatnonzero(_WHITE[own[start : start + limit]])
        stop = start + int(white[-1]) + 1 if len(white) else _next_white(own, start + limit, limit) + 1
        yield text[start:stop]
        start = stop
    if start < len(text) or not start:
        yield text[start:]


def _next_white(own: np.ndarray, start: int, step: int) -> int:
    """The first white space from ``start`` on; the last place if there is none."""
    for low in range(start, len(own), step):
        white = np.flatnonzero(_WHITE[own[low : low + step]])
        if len(white):
            return low + int(white[0])
    return len(own) - 1


def slabs(texts: list[bytes], limit: int = SLAB_BYTES, together: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (bytes, text numbers, starts, stops): pieces joined by single spaces, one before and one after.

    Pieces are packed up to ``together`` bytes (as many as ``limit`` if not given); a longer piece is a slab by itself.

    A text longer than ``limit`` comes as several pieces, all under its number. No word is in two pieces, so a slab is
    longer than ``limit`` where a word is.
    """
    held, numbers, size = [], [], 0
    together = limit if together is None else together

    def packed():
        stops = np.cumsum([len(p) + 1 for p in held])
        starts = stops - [len(p) for p in held]
        slab = np.frombuffer(b" " + b" ".join(held) + b" ", dtype=np.uint8)
        return slab, np.array(numbers, dtype=np.int64), starts, stops

    for number, text in enumerate(texts):
        for piece in cut(text, limit) if len(text) > limit else (text,):
            if held and size + len(piece) > together:
                yield packed()
                held, numbers, size = [], [], 0
            held.append(piece)
            numbers.append(number)
            size += len(piece) + 1
    if held:
        yield packed()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all bits (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(np.full(count - 1, base, dtype=np.uint64), out=out[1:])
    return out


_BASE = 0xD6E8FEB86659FD93
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def run_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hashes of the runs ``codes[start:stop]``, equal for equal runs wherever they stand."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    if base not in _TABLES or len(_TABLES[base][0]) < len(codes) + 1:
        count = -(-(len(codes) + 1) // _GROWTH) * _GROWTH
        _TABLES[base] = _powers(base, count), _powers(pow(base, -1, 1 << 64), count)
    powers, inverse = _TABLES[base]
    sums = np.empty(len(codes) + 1, dtype=np.uint64)
    sums[0] = 0
    own = sums[1:]
    np.add(codes, np.uint64(1), out=own, dtype=np.uint64)
    own *= powers[: len(codes)]
    np.cumsum(own, out=own)
    lengths = (stops - starts).astype(np.uint64)
    return mixed((sums[stops] - sums[starts]) * inverse[starts] + lengths * _ODD)


def white_words(slab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal runs of bytes that are no white space."""
    solid = ~_WHITE[slab]
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    return edges[0::2], edges[1::2]
