"""SentencePiece encoding and decoding through a table of distinct marked words.

A sentencepiece model whose pieces never have a white-space mark behind another character segments every
marked word (a run of marks and the word behind it) by itself. So Spark counts the distinct marked words of the
corpus, segments each frequent one once, and every text becomes a lookup of its words, joined back by position.

The shared table holds the marked words that make up at least ``1 / TABLE_ROWS`` of all occurrences, so it
never has more than ``TABLE_ROWS`` rows, however large the corpus. Marked words outside the table are
segmented where they occur, each distinct one once for as long as the task's own table has room.

Defined results: a null or empty text has no pieces, only begin and end ids; texts are encoded whole,
long ones in pieces cut before white space; repeated rows get the same ids each; other columns pass
through, and those named like a result are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.arrow import map_batches

MARK = "▁"
TABLE_ROWS = 1 << 20
#: Distinct marked words that a task holds, while counting and while encoding, before it starts anew.
HELD_WORDS = 300_000
#: Characters worked on at a time; longer texts are cut before white space.
PIECE_CHARS = 1 << 20
RESULTS = ("n_tokens", "ids", "decoded")

_MARKED = re.compile(r" *[^ ]+| +$")
_CUT = re.compile(r"(?<! ) ")


def processor(model: str) -> sentencepiece.SentencePieceProcessor:
    """The model, if marked words can be segmented by themselves."""
    own = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [own.id_to_piece(i) for i in range(own.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece of this model crosses a white-space mark")
    probe = "  ﬁ  x▁ "
    if own.decode(own.encode(probe)) != probe.replace(MARK, " ") or own.encode("a")[0] != own.piece_to_id(MARK + "a"):
        raise ValueError("only models without normalization, with a mark before the first word, are supported")
    return own


def marked_words(text: str) -> Iterator[list[str]]:
    """Lists of a text's marked words, a space standing for the mark; the first word gets its mark here."""
    text = text.replace(MARK, " ")
    start, first = 0, " "
    while text:
        found = _CUT.search(text, start + PIECE_CHARS) if len(text) - start > PIECE_CHARS else None
        stop = found.start() if found else len(text)
        yield _MARKED.findall(first + text[start:stop])
        if not found:
            return
        start, first = stop, ""


def _texts(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in _texts(batch.column(0)):
            for words in marked_words(text):
                held.update(words)
            if len(held) > HELD_WORDS:
                yield rows()
                held.clear()
    yield rows()


def word_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: the corpus's distinct marked words."""
    counted = documents.select(F.col(f"`{text}`")).mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _segments(own: sentencepiece.SentencePieceProcessor, words: list[str]) -> list[bytes]:
    """Little-endian ids of marked words; encode() puts the first mark itself, but before nothing it puts none."""
    alone = own.piece_to_id(MARK)
    found = own.encode([w[1:] for w in words], num_threads=1)
    return [np.array(ids or [alone], dtype="<u4").tobytes() for ids in found]


def segment_table(counts: DataFrame, model: str, rows: int = TABLE_ROWS) -> DataFrame:
    """``word, ids`` of the marked words that are at least a ``rows``-th of all occurrences; ``counts`` is read twice."""
    total = counts.agg(F.sum("n")).first()[0] or 0

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = processor(model)
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_segments(own, words), pa.binary())], ["word", "ids"])

    return counts.filter(F.col("n") * rows >= total).select("word").mapInArrow(segmented, "word string, ids binary")


class Encoder:
    """Encodes and decodes texts with the shared table and a task's own one."""

    def __init__(self, model: str, table: dict[str, bytes]):
        self.own, self.table, self.rare = processor(model), table, {}
        self.begin, self.end, self.mark = self.own.bos_id(), self.own.eos_id(), self.own.piece_to_id(MARK)

    def ids(self, words: list[str]) -> bytes:
        if len(self.rare) > HELD_WORDS:
            self.rare = {}
        missing = [w for w in set(words) if w not in self.table and w not in self.rare]
        self.rare.update(zip(missing, _segments(self.own, missing)))
        table, rare = self.table, self.rare
        return b"".join([table.get(w) or rare[w] for w in words])

    def text(self, parts: list[bytes]) -> str:
        """decode() of all ids: of each part's, where a mark stands in for what came before."""
        lists = [np.frombuffer(p, dtype="<u4").tolist() for p in parts]
        if len(lists) < 2:
            return self.own.decode([self.begin, *(lists[0] if lists else ()), self.end])
        return "".join([self.own.decode(lists[0]), *(self.own.decode([self.mark, *p]) for p in lists[1:])])

    def both(self, text: str) -> tuple[bytes, str]:
        parts = [self.ids(words) for words in marked_words(text)]
        edges = np.array([self.begin, self.end], dtype="<u4").tobytes()
        return b"".join([edges[:4], *parts, edges[4:]]), self.text(parts)


def encode(documents: DataFrame, table: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Rows with ``n_tokens`` (begin and end included), ``ids`` (little-endian 32-bit) and ``decoded``.

    ``table`` comes from :func:`segment_table` and has at most ``TABLE_ROWS`` rows.
    """
    rows = table.toPandas()
    shared = documents.sparkSession.sparkContext.broadcast(dict(zip(rows.word, rows.ids.map(bytes))))
    kept = [c for c in documents.columns if c not in RESULTS]
    schema = documents.select(*[f"`{c}`" for c in kept]).schema
    schema = schema.add("n_tokens", "long").add("ids", "binary").add("decoded", "string")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, shared.value)
        for batch in batches:
            ids, decoded, size, first = [], [], 0, 0
            for i, text in enumerate(_texts(batch.column(len(kept)))):
                found = encoder.both(text)
                ids.append(found[0])
                decoded.append(found[1])
                size += len(text)
                if size > 8 * PIECE_CHARS or i + 1 == batch.num_rows:
                    columns = [batch.column(c).slice(first, len(ids)) for c in range(len(kept))]
                    counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                    columns += [counts, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)
                    ids, decoded, size, first = [], [], 0, i + 1

    own = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("text" + "_" * max(map(len, [*kept, ""]))))
    return map_batches(own, encoded, schema)
