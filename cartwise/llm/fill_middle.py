"""Fill-in-the-middle: documents cut at two random places and put in another order between marks.

Places are counted in code points, texts are held in UTF-8. A rolling hash over ``WINDOW`` bytes cuts texts into chunks
wherever its low bits vanish, so passages that documents share become equal chunks. What a chunk adds to its document is
worked out once for each task and kept under the chunk's content: its code points, whether a mark is in
it, and its first and last bytes, by which marks across chunks show. Adding up the code points finds the chunk that a
cut falls into, and only that chunk is searched.

Random numbers come from the SHA-256 of salt and document id: a text gets the same form in any run and place.

Defined results: a null text is empty; an empty text and one that holds a mark stay plain; a null id counts as
an empty one; rows that repeat are as many rows; other columns are ignored; an empty table gives an empty table. A text
is whole in its row and in memory, its hashes only for ``SLAB`` bytes at a time; remembered chunks take ``HELD`` bytes at most twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.slabs import byte_texts, mixed

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_REACH = max(len(m) for m in _MARKS) - 1
#: Bytes under the rolling hash, its low bits that make a cut (one byte in 512), and the longest chunk.
WINDOW = 32
_CUT = np.uint64(511)
LONGEST = 1 << 13
#: Bytes hashed at a time, remembered at a time, and sent back at a time.
SLAB = 1 << 20
HELD = 1 << 25
SENT = 1 << 24
_GEAR = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _rolled(codes: np.ndarray) -> np.ndarray:
    """At each byte the sum of the last ``WINDOW`` bytes' numbers, each shifted by its distance."""
    out, span = _GEAR[codes], 1
    while span < WINDOW:
        out[span:] += out[:-span] << np.uint64(span)
        span *= 2
    return out


def chunk_stops(text: bytes) -> list[int]:
    """Where the text's chunks end. A place depends on the bytes before it only, up to ``WINDOW`` or a chunk's length."""
    codes, stops, last = np.frombuffer(text, dtype=np.uint8), [], 0
    for low in range(0, len(codes), SLAB):
        first = max(low - WINDOW + 1, 0)
        hashed = _rolled(codes[first : low + SLAB])
        # High bits of a sum of shifted numbers take in the whole window.
        places = np.flatnonzero((hashed >> np.uint64(40)) & _CUT == 0) + first + 1
        for stop in places[places > max(low, WINDOW - 1)].tolist():
            stops += range(last + LONGEST, stop, LONGEST)
            stops.append(stop)
            last = stop
    stops += range(last + LONGEST, len(text), LONGEST)
    if text and (not stops or stops[-1] < len(text)):
        stops.append(len(text))
    return stops


class Memory:
    """Summaries of chunks by content; the older half is dropped when both halves are full."""

    def __init__(self) -> None:
        self.new: dict[bytes, tuple[int, bool]] = {}
        self.old: dict[bytes, tuple[int, bool]] = {}
        self.size = 0

    def summary(self, chunk: bytes) -> tuple[int, bool]:
        """Code points that begin in the chunk, and whether a mark is in it."""
        found = self.new.get(chunk)
        if found is None:
            found = self.old.get(chunk) or (_points(chunk), any(m in chunk for m in _MARKS))
            if self.size + len(chunk) > HELD:
                self.old, self.new, self.size = self.new, {}, 0
            self.new[chunk] = found
            self.size += len(chunk)
        return found


def _starts(chunk: bytes) -> np.ndarray:
    return np.frombuffer(chunk, dtype=np.uint8) & 0xC0 != 0x80


def _points(chunk: bytes) -> int:
    return int(np.count_nonzero(_starts(chunk)))


class Chunked:
    """A text by its chunks: code points, marks, and byte places of code points."""

    def __init__(self, text: bytes, memory: Memory) -> None:
        self.text, self.stops = text, [0, *chunk_stops(text)]
        self.before, self.marked, tail = [0], False, b""
        for start, stop in zip(self.stops, self.stops[1:]):
            chunk = text[start:stop]
            points, marked = memory.summary(chunk)
            self.before.append(self.before[-1] + points)
            seam = tail + chunk[:_REACH]
            self.marked = self.marked or marked or any(m in seam for m in _MARKS)
            tail = (tail + chunk[-_REACH:])[-_REACH:]

    @property
    def points(self) -> int:
        return self.before[-1]

    def place(self, point: int) -> int:
        """The byte at which the code point begins; the end for one past the last."""
        if point >= self.points:
            return len(self.text)
        at = int(np.searchsorted(self.before, point, side="right")) - 1
        start = self.stops[at]
        return start + int(np.flatnonzero(_starts(self.text[start : self.stops[at + 1]]))[point - self.before[at]])


def _numbers(salt: str, key: Column) -> list[Column]:
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(drawn, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(documents: DataFrame, key: str = "doc_id", text: str = "text", salt: str = "1", changed: int = 90, suffix_first: int = 20) -> DataFrame:
    """``<key>, n, form, prefix_chars, middle_chars, output``: ``changed`` percent get a new order, ``suffix_first`` percent of them spm."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            keys = batch.column("key")
            drawn = zip(*[batch.column(f"h{k}").to_pylist() for k in (1, 2, 3, 4)])
            out, first, size = [], 0, 0
            for number, (own, (h1, h2, h3, h4)) in enumerate(zip(byte_texts(batch.column("text")), drawn)):
                chunked = Chunked(own, memory)
                n = chunked.points
                if not n or chunked.marked or h3 % 100 >= changed:
                    out.append((n, "plain", None, None, own))
                else:
                    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = chunked.place(low), chunked.place(high)
                    p, s, m = _MARKS[0] + own[:a], _MARKS[1] + own[b:], _MARKS[2] + own[a:b]
                    spm = h4 % 100 < suffix_first
                    out.append((n, "spm" if spm else "psm", low, high - low, s + p + m if spm else p + s + m))
                size += len(own)
                if size > SENT:
                    yield _batch(keys.slice(first, len(out)), out)
                    out, first, size = [], number + 1, 0
            yield _batch(keys.slice(first, len(out)), out)

    own = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), *_numbers(salt, F.col(f"`{key}`")))
    kind = dict(own.dtypes)["key"]
    found = own.mapInArrow(rows, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return found.withColumnRenamed("key", key)


def _batch(keys: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    n, form, low, middle, output = zip(*rows) if rows else [()] * 5
    arrays = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(low, pa.int64()), pa.array(middle, pa.int64())]
    text = pa.array(output, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([keys, *arrays, text], ["key", "n", "form", "prefix_chars", "middle_chars", "output"])


def restore(output: Column, form: Column) -> Column:
    """The text, rebuilt from output and form alone. The first of each mark is the one that was put in."""
    long = len(PREFIX)
    first, second, third = F.instr(output, PREFIX), F.instr(output, SUFFIX), F.instr(output, MIDDLE)
    tail = F.substring(output, third + long, F.length(output))
    psm = F.concat(F.substring(output, F.lit(long + 1), second - (long + 1)), tail, F.substring(output, second + long, third - second - long))
    spm = F.concat(F.substring(output, first + long, third - first - long), tail, F.substring(output, F.lit(long + 1), first - (long + 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
