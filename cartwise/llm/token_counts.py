"""Token counts by a byte-pair tokenizer compiled to a finite-state transducer.

A byte-level BPE tokenizer is compiled to a deterministic transducer over bytes. Within a word of the
pre-tokenizer, the encoding of every prefix ends in one certain token: the one whose predecessor is the
prefix before it and which no merge crosses. A state holds, for each place where a longer token may still have
begun, the tree node of what was read since, the token that ended there, and how many tokens came since. A
transition carries the change of the number of tokens (it can be negative: a later byte can join tokens).
States and transitions are worked out when first met and kept in arrays, so that numpy steps many chunks at once.

Texts are cut into chunks of ``CHUNK`` bytes. A chunk with a word boundary maps every entering state to the
same leaving state; one without runs from an assumed state, and again if a preceding chunk leaves another.
The maps compose along the text: what comes before the first boundary of a chunk runs from the state its
predecessor leaves, until no entry changes.

Special tokens inside texts count as one token each, as the library has it by default.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows get the same counts each; other
columns pass through, and those named like a result are replaced; an empty table gives an empty table. A text is
never cut: a word of two million characters without a boundary took 842 MB, since states are dropped between calls only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.arrow import map_batches

CHUNK = 512
SLAB_CHARS = 2 << 20
#: States kept before the transducer is started anew (4 bytes for each and each byte value met).
HELD_STATES = 100_000
OTHER, LETTER, NUMBER, WHITE, STOP = range(5)
#: Fixed values of the pre-tokenizer: endings split off behind an apostrophe.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
RESULTS = ("n_bytes", "n_tokens")
_NEVER = 1 << 60


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes: printable Latin-1 ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def character_classes(tokenizer: str) -> np.ndarray:
    """The class of every code point, asked of the library's own pre-tokenizer."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(tokenizer).pre_tokenizer.pre_tokenize_str
    classes = np.full(0x110000 + 1, WHITE, dtype=np.uint8)
    for low in range(0, 0x110000, 1 << 14):
        block = "".join(chr(c) for c in range(low, low + (1 << 14)) if not 0xD800 <= c < 0xE000 and c not in (32, 39))
        for _, (start, stop) in split(block):  # runs of one class
            for probe, kind in (("!", OTHER), ("a", LETTER), ("1", NUMBER)):
                if len(split(probe + block[start])) == 1:
                    classes[[ord(c) for c in block[start:stop]]] = kind
    classes[32], classes[39], classes[-1] = WHITE, OTHER, STOP
    return classes


class Transducer:
    """Counts the tokens of single words; states are numbered as they are met, 0 is a word's begin."""

    def __init__(self, tokenizer: str):
        spec = json.loads(Path(tokenizer).read_text(encoding="utf-8"))
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("only byte-level BPE tokenizers without a prefix space are supported")
        if spec["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("normalizers, dropout and ignored merges are not supported")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError("added tokens that take white space or whole words are not supported")
        self.special = [a["content"] for a in spec["added_tokens"]]
        alphabet = _byte_alphabet()
        vocab = {t: i for t, i in model["vocab"].items() if t not in set(self.special)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        parts = {vocab[a + b]: (vocab[a], vocab[b], r) for r, (a, b) in reversed(list(enumerate(pairs)))}
        # The tokens at a token's right and left edge, from a byte up, each with the rank that ends it.
        self.right = {i: self._edge(i, parts, 1) for i in vocab.values()}
        self.left = {i: self._edge(i, parts, 0) for i in vocab.values()}
        self.child: dict[int, int] = {}
        self.token, self.inner = [-1], [False]
        for text, i in vocab.items():
            if i not in parts and len(text) > 1:
                continue  # no merge makes it
            node = 0
            for c in text:
                self.inner[node] = True
                step = node << 8 | alphabet[c]
                if step not in self.child:
                    self.child[step] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.child[step]
            self.token[node] = i
        self._apart: dict[tuple[int, int], bool] = {}
        self.restart()

    def restart(self) -> None:
        begin = ((0, -1, 0),)
        self.states, self.number = [begin], {begin: 0}
        self.bytes, self.column = [], np.zeros(256, dtype=np.int32)
        self.met = np.zeros(256, dtype=bool)
        self.moves = np.full((1024, 64), -1, dtype=np.int32)  # next state * 256 + change + 128

    @staticmethod
    def _edge(token: int, parts: dict, side: int) -> list[tuple[int, int]]:
        found, ends = [], _NEVER
        while True:
            found.append((token, ends))
            if token not in parts:
                return found[::-1]
            ends = parts[token][2]
            token = parts[token][side]

    def apart(self, first: int, second: int) -> bool:
        """Whether encoding the two tokens' bytes gives the two tokens: no merge crosses in time."""
        if first < 0:
            return True
        known = self._apart.get((first, second))
        if known is None:
            known, i, j = True, 0, 0
            edge, other = self.right[first], self.left[second]
            while known:
                (a, ends), (b, stops) = edge[i], other[j]
                crossing = self.rank.get((a, b), _NEVER)
                if crossing < ends and crossing <= stops and crossing != _NEVER:
                    known = False
                elif ends == stops == _NEVER:
                    break
                elif ends <= stops:
                    i += 1
                else:
                    j += 1
            self._apart[first, second] = known
        return known

    def _step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        grown, last, change = [], None, 0
        for node, before, since in state:  # the earliest begin first
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            if last is None and self.token[node] >= 0 and self.apart(before, self.token[node]):
                last, change = self.token[node], 1 - since
            if self.inner[node]:
                grown.append((node, before, since))
        return (*((n, t, since + change) for n, t, since in grown), (0, last, 0)), change

    def compile(self, states: np.ndarray, columns: np.ndarray) -> None:
        """Work out transitions."""
        width = self.moves.shape[1]
        for key in np.unique(states * width + columns).tolist():
            state, column = divmod(key, width)
            reached, change = self._step(self.states[state], self.bytes[column])
            number = self.number.setdefault(reached, len(self.states))
            if number == len(self.states):
                self.states.append(reached)
                if number == len(self.moves):
                    self.moves = np.concatenate([self.moves, np.full_like(self.moves, -1)])
            self.moves[state, column] = number << 8 | change + 128

    def meet(self, data: np.ndarray) -> None:
        """Give a column to every byte value met, the most frequent first."""
        counts = np.bincount(data, minlength=256)
        fresh = [b for b in np.argsort(-counts, kind="stable").tolist() if counts[b] and not self.met[b]]
        for b in fresh:
            self.column[b], self.met[b] = len(self.bytes), True
            self.bytes.append(b)
        while len(self.bytes) > self.moves.shape[1]:
            self.moves = np.concatenate([self.moves, np.full_like(self.moves, -1)], axis=1)

    def run(self, feed: np.ndarray, starts: np.ndarray, stops: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaving states and token counts of ``feed[start:stop]`` from the entry states.

        ``feed`` holds the columns of bytes, those of words' first bytes inverted.
        """
        order = np.argsort(starts - stops, kind="stable")
        at, falling = starts[order].astype(np.int64), (starts - stops)[order]
        state, count = entry[order].astype(np.int64), np.zeros(len(order), dtype=np.int64)
        width, moves = self.moves.shape[1], self.moves.ravel()
        for step in range(-int(falling[0]) if len(order) else 0):
            n = int(np.searchsorted(falling, -step, side="left"))
            column = feed[at[:n]]
            inside = column >= 0
            own = state[:n] * inside
            np.bitwise_xor(column, -1, out=column, where=~inside)
            key = own * width + column
            move = moves[key]
            if move.min() < 0:
                missing = move < 0
                self.compile(own[missing], column[missing])
                moves = self.moves.ravel()
                move = moves[key]
            state[:n] = move >> 8
            count[:n] += (move & 255) - 128
            at[:n] += 1
        left, counts = np.empty_like(state), np.empty_like(count)
        left[order], counts[order] = state, count
        return left, counts


def word_begins(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer starts a word; ``points`` are code points, texts end in ``0x110000``."""
    kind = classes[points]
    white = kind == WHITE
    begins = np.empty(len(points), dtype=bool)
    begins[:1] = True
    begins[1:] = kind[1:] != kind[:-1]
    if len(points) < 2:
        return begins
    # The last white space before a word is apart from those before it; a space belongs to the word.
    last = np.flatnonzero(white[:-1] & ~white[1:] & (kind[1:] != STOP))
    begins[last] = True
    bound = last[points[last] == 32] + 1
    begins[bound] = False
    # An apostrophe that starts a word, with an ending right behind it.
    padded = np.concatenate([points, np.full(3, 0x110000, dtype=points.dtype)])
    quote = np.flatnonzero((points == 39) & begins)
    for ending in ENDINGS:
        here = quote[np.all([padded[quote + 1 + i] == ord(c) for i, c in enumerate(ending)], axis=0)]
        begins[here + 1] = False
        after = here + 1 + len(ending)
        begins[after[after < len(points)]] = True
    return begins


def counts_of(texts: list[str], transducer: Transducer, classes: np.ndarray) -> np.ndarray:
    """Token counts of texts without special tokens."""
    out = np.zeros(len(texts), dtype=np.int64)
    own = [i for i, t in enumerate(texts) if t]
    if not own:
        return out
    joined = "".join(texts[i] for i in own)
    ends = np.cumsum([len(texts[i]) for i in own])
    points = np.insert(np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.int64), ends, 0x110000)
    starting = word_begins(points, classes)[points != 0x110000]
    starting[0] = True
    starting[ends[:-1]] = True
    data = np.frombuffer(joined.encode(), dtype=np.uint8)
    first = np.flatnonzero(data & 0xC0 != 0x80)  # of each character
    begins = np.zeros(len(data), dtype=bool)
    begins[first[starting]] = True
    transducer.meet(data)
    feed = transducer.column[data]
    feed[begins] ^= -1
    limits = np.concatenate([[0], np.append(first, len(data))[ends]])
    chunks = -(-np.diff(limits) // CHUNK)
    text = np.repeat(np.arange(len(own)), chunks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = limits[text] + nth * CHUNK
    stop = np.minimum(start + CHUNK, limits[text + 1])
    places = np.flatnonzero(begins)
    boundary = places[np.minimum(np.searchsorted(places, start), len(places) - 1)]
    constant = (boundary >= start) & (boundary < stop)  # whatever enters, the same leaves
    left, counts = transducer.run(feed, np.where(constant, boundary, start), stop, np.zeros(len(start), dtype=np.int64))
    later = nth > 0
    heads = np.flatnonzero(later & constant & (boundary > start))
    entry = np.zeros(len(start), dtype=np.int64)
    while True:  # chunks inside one word, until they agree with their predecessors
        came = np.where(later, np.roll(left, 1), 0)
        anew = np.flatnonzero(~constant & (came != entry))
        if not len(anew):
            break
        entry[anew] = came[anew]
        left[anew], counts[anew] = transducer.run(feed, start[anew], stop[anew], entry[anew])
    counts[heads] += transducer.run(feed, start[heads], boundary[heads], left[heads - 1])[1]
    np.add.at(out, np.array(own)[text], counts)
    return out


_LOADED: dict[str, Transducer] = {}


def _transducer(tokenizer: str) -> Transducer:
    """One per worker process and tokenizer; its states serve all tasks."""
    if tokenizer not in _LOADED:
        _LOADED[tokenizer] = Transducer(tokenizer)
    if len(_LOADED[tokenizer].states) > HELD_STATES:
        _LOADED[tokenizer].restart()
    return _LOADED[tokenizer]


def count_batch(texts: list[str], tokenizer: str, classes: np.ndarray) -> np.ndarray:
    transducer = _transducer(tokenizer)
    out = np.zeros(len(texts), dtype=np.int64)
    special = re.compile("|".join(re.escape(s) for s in sorted(transducer.special, key=len, reverse=True)) or r"(?!)")
    parts, numbers, size = [], [], 0

    def flush():
        np.add.at(out, np.array(numbers, dtype=np.int64), counts_of(parts, _transducer(tokenizer), classes))

    for i, text in enumerate(texts):
        pieces = special.split(text) if any(s in text for s in transducer.special) else [text]
        out[i] += len(pieces) - 1
        for piece in pieces:
            if parts and size + len(piece) > SLAB_CHARS:
                flush()
                parts, numbers, size = [], [], 0
            parts.append(piece)
            numbers.append(i)
            size += len(piece)
    if parts:
        flush()
    return out


def count_tokens(documents: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Every row's other columns with ``n_bytes`` and ``n_tokens``."""
    shared = documents.sparkSession.sparkContext.broadcast(character_classes(tokenizer))  # a byte for each code point
    kept = [c for c in documents.columns if c not in (*RESULTS, text)]
    schema = documents.select(*[f"`{c}`" for c in kept]).schema.add("n_bytes", "long").add("n_tokens", "long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(len(kept)).to_pylist()]
            columns = [batch.column(i) for i in range(len(kept) + 2) if i != len(kept)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count_batch(texts, tokenizer, shared.value))], schema.names)

    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    longest = "_" * max(map(len, [*kept, ""]))
    own = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("text" + longest), size.alias("size" + longest))
    return map_batches(own, counted, schema)
