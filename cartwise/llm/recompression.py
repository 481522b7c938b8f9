"""Substring dedup: long repeats of words found by recompression.

Words are symbols, named by a hash. In each of ``ROUNDS`` rounds every symbol falls on one of two sides by its
name, and each pair of a first-side symbol and a second-side symbol behind it is joined to one symbol, named by
a hash of the two names. Names depend on content alone, so tasks name alike without a common dictionary, and
whether two neighbours are joined depends on them alone: equal word sequences get equal symbols, but for
``MARGIN`` words at either end. (Runs of one symbol stay apart in all rounds; a run has no end inside a window.)

A phrase is the shortest row of symbols of at least ``PHRASE`` words. The inside of every window holds at least one
phrase, and the window is filed under the one with the smallest hash, which equal windows share. Only phrases
that several documents file windows under are worked on: their windows are hashed, and Spark finds for each
the first document that has it. Consecutive windows under one phrase go as one row to the phrase's task; only under a
phrase of more than ``SELDOM`` documents each window goes by itself. Repeats within a document never leave its task.
Documents of equal words are settled by a digest, so groups of copies send nothing but their first.

Windows are compared by two 64-bit hashes: that of the phrase and that of all words, or under a phrase of more than
``SELDOM`` documents two of all words.

Defined results: documents are ordered by id (null first), then ``xxhash64`` of the text; rows that agree in
both are one document and keep the same words; a null text has no words; a text of fewer words than a window
stays; every ``kept`` text has its words joined by one space; other columns pass through, and those
named like a result are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.arrow import map_batches
from cartwise.llm.bounded import small
from cartwise.llm.slabs import byte_texts, mixed, run_hashes
from cartwise.llm.word_runs import word_arrays
from cartwise.session import materialise

WINDOW = 20
ROUNDS = 2
#: A place between symbols is settled by this many words on either side: two after the second round.
MARGIN = 2
#: A symbol has four words at most, so the first one wholly inside starts by the sixth word of a window, and a phrase
#: from there ends before the window does.
PHRASE = 8
#: Windows under a phrase of at most this many documents meet in one task.
SELDOM = 1000
RESULTS = ("n_words", "n_removed", "kept")
_OTHER_BASE = 0xA0761D6478BD642F


def symbols(words: np.ndarray) -> np.ndarray:
    """The places where symbols start after all rounds, and the number of words."""
    names, starts = words, np.arange(len(words))
    for number in range(ROUNDS):
        second = mixed(names + np.uint64(number + 1)) >> np.uint64(63) == 1
        joined = ~second[:-1] & second[1:]
        pairs = mixed(names[:-1] * np.uint64(0x9E3779B97F4A7C15) + names[1:] + np.uint64(number))
        names = np.append(np.where(joined, pairs, names[:-1]), names[-1:])
        own = np.concatenate([[True], ~joined])[: len(names)]
        names, starts = names[own], starts[own]
    return np.append(starts, len(words))


def window_hashes(words: np.ndarray, base: int | None = None) -> np.ndarray:
    first = np.arange(max(len(words) - WINDOW + 1, 0))
    return run_hashes(words, first, first + WINDOW) if base is None else run_hashes(words, first, first + WINDOW, base)


def filed(words: np.ndarray) -> np.ndarray:
    """For every window the hash of the phrase it is filed under."""
    edges = symbols(words)
    ends = np.searchsorted(edges, edges[:-1] + PHRASE)
    whole = ends < len(edges)
    first, last = edges[:-1][whole], edges[ends[whole]]
    hashes = run_hashes(words, first, last)
    window = np.arange(len(words) - WINDOW + 1)
    low = np.searchsorted(first, window + MARGIN)
    high = np.searchsorted(last, window + WINDOW - MARGIN, side="right")  # of phrases that end inside
    # The smallest of hashes[low:high], from two overlapping stretches of a power of two.
    levels, size = [hashes], 1
    while 2 * size <= WINDOW:
        levels.append(np.minimum(levels[-1][: max(len(levels[-1]) - size, 0)], levels[-1][size:]))
        size *= 2
    out = np.empty(len(window), dtype=np.uint64)
    spread = high - low
    for level, table in enumerate(levels):
        here = np.flatnonzero((spread >> level) == 1)
        out[here] = np.minimum(table[low[here]], table[high[here] - (1 << level)])
    return out


def _first_starts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the first start of an equal one in the document, and the distinct first starts."""
    _, first, own = np.unique(hashes, return_index=True, return_inverse=True)
    return first[own], np.sort(first)


def described(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``k, t, n, d, e, inner, phrases``: size, two digests of the words, whether a window repeats inside, distinct phrases.

    Of documents with equal words in a batch only the first has phrases.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = list(zip(batch.column("k").to_pylist(), batch.column("t").to_pylist()))
            n, digests, inner, phrases, first = [], [], [], [], {}
            for i, words in word_arrays(byte_texts(batch.column("text")), lower=False):
                zero, end = np.zeros(1, dtype=np.int64), np.array([len(words)])
                digest = int(run_hashes(words, zero, end)[0]), int(run_hashes(words, zero, end, _OTHER_BASE)[0])
                n.append(len(words))
                digests.append(digest)
                phrases.append(None)
                inner.append(False)
                if len(words) < WINDOW:
                    continue
                hashes = window_hashes(words)
                inner[-1] = len(np.unique(hashes)) < len(hashes)
                order = (ids[i][0] is not None, ids[i][0] or 0, ids[i][1])
                before = first.get(digest)
                if before is None or order < before[0]:
                    phrases[-1] = np.unique(filed(words)).view(np.int64)
                    if before is not None:
                        phrases[before[1]] = None
                    first[digest] = order, i
            both = np.array(digests, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            arrays = [pa.array(n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(inner, pa.bool_()), pa.array(phrases, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("t"), *arrays], ["k", "t", "n", "d", "e", "inner", "phrases"])

    own = documents.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    return own.mapInArrow(rows, "k long, t long, n long, d long, e long, inner boolean, phrases array<long>")


def _same(left: DataFrame, right: DataFrame):
    return left.k.eqNullSafe(right.k) & (left.t == right.t)


def _shared_phrases(entries: DataFrame, firsts: DataFrame) -> DataFrame:
    """``k, t, phrase, often`` of first documents where another first document has the phrase; ``often`` if more than ``SELDOM`` have."""
    sent = entries.filter(F.col("phrases").isNotNull()).select("k", "t", F.explode("phrases").alias("phrase"))
    counts = sent.groupBy("phrase").agg(F.count("*").alias("n")).filter("n > 1").select("phrase")
    some = materialise(sent.join(counts, "phrase"), "phrases")
    own = some.join(firsts, _same(some, firsts), "left_semi").distinct()
    again = own.groupBy("phrase").agg(F.count("*").alias("n")).filter("n > 1").select("phrase", (F.col("n") > SELDOM).alias("often"))
    return own.join(again, "phrase")


def _windows(documents: DataFrame, phrases: DataFrame, key: str, text: str) -> DataFrame:
    """``phrase, often, k, t, start, v, w``: the distinct windows filed under a document's ``phrases``, at their first start there.

    Consecutive ones under one phrase are a row; ``w`` is empty unless ``often``.
    """
    own = documents.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    ids = materialise(phrases.select("k", "t"), "ids")
    own = own.join(small(ids), _same(own, ids), "left_semi")
    both = own.join(phrases, _same(own, phrases)).select(own.k, own.t, "text", "phrases", "often")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted, common = (batch.column("k"), batch.column("t")), batch.column("phrases"), batch.column("often")
            for i, words in word_arrays(byte_texts(batch.column("text")), lower=False):
                hashes = window_hashes(words)
                first = _first_starts(hashes)[1]
                under = filed(words)[first].view(np.int64)
                here = np.isin(under, wanted[i].values.to_numpy())
                first, under = first[here], under[here]
                begins = np.flatnonzero(np.append(True, (np.diff(first) != 1) | (under[1:] != under[:-1]))[: len(first)])
                sizes = np.diff(np.append(begins, len(first)))
                often = np.isin(under[begins], common[i].values.to_numpy())
                v, w = hashes[first], np.zeros(0, dtype=np.uint64)
                if often.any():
                    w = window_hashes(words, _OTHER_BASE)[first][np.repeat(often, sizes)]
                owner = pa.array(np.full(len(begins), i))
                lists = [_lists(v, sizes), _lists(w, sizes * often)]
                arrays = [pa.array(under[begins]), pa.array(often), *[c.take(owner) for c in ids], pa.array(first[begins].astype(np.int32)), *lists]
                yield pa.RecordBatch.from_arrays(arrays, ["phrase", "often", "k", "t", "start", "v", "w"])

    return both.mapInArrow(rows, "phrase long, often boolean, k long, t long, start int, v array<long>, w array<long>")


def _lists(hashes: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(hashes.view(np.int64)))


def _later(found: DataFrame) -> DataFrame:
    """``k, t, start`` of windows that an earlier document has too."""
    place, owner = F.struct("k", "t"), F.col("owner")
    second = ~(F.col("k").eqNullSafe(owner.k) & (F.col("t") == owner.t))
    start = (F.col("start") + F.col("at")).alias("start")
    # Dealt by phrase alone, so a row is taken apart only where it arrived.
    runs = found.filter("NOT often").select("phrase", "k", "t", "start", "v").repartition("phrase")
    each = runs.select("phrase", "k", "t", "start", F.posexplode("v").alias("at", "v")).select("phrase", "v", "k", "t", start)
    seldom = each.withColumn("owner", F.min(place).over(Window.partitionBy("phrase", "v"))).filter(second)
    each = found.filter("often").select("k", "t", "start", F.posexplode(F.arrays_zip("v", "w")).alias("at", "x")).select("x.v", "x.w", "k", "t", start)
    owners = each.groupBy("v", "w").agg(F.min(place).alias("owner"), F.count("*").alias("n")).filter("n > 1").select("v", "w", "owner")
    owners = materialise(owners, "owners")  # apart, so that the join can split the rows of one window over tasks
    often = each.join(owners, ["v", "w"]).filter(second)
    return seldom.select("k", "t", "start").union(often.select("k", "t", "start"))


def marks(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``k, t, whole, starts`` of documents that lose words: all of them, or those of windows equal to one at a start."""
    entries = materialise(described(documents, key, text), "entries")
    place = F.struct("k", "t")
    classes = entries.filter(F.col("n") >= WINDOW).groupBy("d", "e").agg(F.min(place).alias("first"))
    classes = materialise(classes, "classes")
    firsts = classes.select("first.k", "first.t")
    copies = entries.select("k", "t", "d", "e").join(classes, ["d", "e"])
    copies = copies.filter(~(F.col("k").eqNullSafe(F.col("first.k")) & (F.col("t") == F.col("first.t"))))
    copies = copies.select("k", "t", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("starts")).distinct()
    often = F.collect_list(F.when(F.col("often"), F.col("phrase")))  # of the others null, which no list keeps
    shared = _shared_phrases(entries, firsts).groupBy("k", "t").agg(F.collect_list("phrase").alias("phrases"), often.alias("often"))
    found = materialise(_windows(documents, materialise(shared, "shared"), key, text), "windows")
    # Documents that only repeat themselves have no start here.
    inner = entries.filter("inner").select("k", "t", F.lit(None).cast("int").alias("start"))
    some = _later(found).union(inner).groupBy("k", "t").agg(F.collect_list("start").alias("starts"))
    some = some.join(copies, _same(some, copies), "left_anti").select("k", "t", F.lit(False).alias("whole"), "starts")
    return materialise(copies.union(some), "marks")


def _kept(text: bytes, words: np.ndarray, starts: np.ndarray) -> tuple[int, bytes]:
    """The number of removed words, and the rest."""
    hashes = window_hashes(words)
    owner, first = _first_starts(hashes)
    gone = owner != np.arange(len(owner))
    gone |= np.isin(owner, starts)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(gone)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    left = np.cumsum(covered[:-1]) == 0
    own = text.split()
    return int(len(words) - left.sum()), b" ".join([own[i] for i in np.flatnonzero(left).tolist()])


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's other columns with ``n_words``, ``n_removed`` and the ``kept`` text."""
    columns = [c for c in documents.columns if c not in (*RESULTS, text)]
    schema = T.StructType([*documents.select(*[f"`{c}`" for c in columns]).schema.fields])
    schema = schema.add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept", T.StringType())
    end = "_" * max(map(len, [*documents.columns, ""]))
    own = documents.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("text" + end), F.col(key).cast("long").alias("k" + end), F.xxhash64(text).alias("t" + end))
    found = marks(documents, key, text).select(*[F.col(c).alias(f"marked {c}{end}") for c in ("k", "t", "whole", "starts")])
    same = F.col("k" + end).eqNullSafe(F.col(f"marked k{end}")) & (F.col("t" + end) == F.col(f"marked t{end}"))
    both = own.join(found, same, "left").select(*[f"`{c}`" for c in columns], "text" + end, f"marked whole{end}", f"marked starts{end}")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(columns)
        for batch in batches:
            texts, whole, starts = byte_texts(batch.column(at)), batch.column(at + 1).to_pylist(), batch.column(at + 2)
            some = [i for i, w in enumerate(whole) if w is False]
            arrays = word_arrays([texts[i] for i in some], lower=False)
            partly = {some[i]: _kept(texts[some[i]], w, starts[some[i]].values.drop_null().to_numpy()) for i, w in arrays}
            n, removed, kept = [], [], []
            for i, own_text in enumerate(texts):
                own_words = own_text.split()
                n.append(len(own_words))
                lost, rest = (len(own_words), b"") if whole[i] else partly.get(i) or (0, b" ".join(own_words))
                removed.append(lost)
                kept.append(rest)
            arrays = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(at)], *arrays], schema.names)

    return map_batches(both, rows, schema)
