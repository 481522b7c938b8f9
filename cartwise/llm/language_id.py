"""Language identification by n-gram filters that hold every language at once.

An n-gram is four bytes of the lower-cased text, where everything but letters counts as a space and
spaces stand only at the ends. Spark counts all n-grams of all texts by language. A language contains an
n-gram that makes up at least ``Settings.least_share`` of its n-grams, and at least ``Settings.least_ratio``
of what the n-gram makes up in the language where it is most common.

The filter is a Bloom filter sliced by language: every slot is a bit mask over the languages, and the
masks in an n-gram's slots, and-ed, give all languages that contain it. A text's hits are counted by
language. With f the chance of a false hit (the language's share of set slots to the power of the
hashes), x hits among n n-grams stand for (x - n f) / (1 - f) true ones; the most true hits decide.
``score`` is their share of n.

A language holds at most ``1 / least_share`` n-grams, which bounds what reaches the driver and the executors
whatever the size of the corpus.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing
was learned. Ties go to the language that sorts first. Repeated rows get the same answer each; a key
column may be null; texts are read whole, in pieces of bounded size. More than ``Settings.most_languages`` learned values raise
``ValueError``, since a slot takes a bit for each of them: raise the setting for more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.arrow import map_batches
from cartwise.llm.slabs import SPACE, byte_texts, slabs

UNKNOWN = "und"
MASK_BITS = 63
_LETTERS = np.full(256, SPACE, dtype=np.uint8)
for _low, _high in ((97, 123), (128, 256)):
    _LETTERS[_low:_high] = np.arange(_low, _high)
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Settings:
    least_share: float = 2e-5
    least_ratio: float = 0.25
    slots_per_gram: int = 12
    hashes: int = 2
    most_languages: int = 1000


@dataclass(frozen=True)
class Filters:
    """``slots[w]`` holds the bit masks of languages 63 w to 63 w + 62."""

    languages: list[str]
    slots: np.ndarray
    false_hits: np.ndarray

    def masks(self, grams: np.ndarray, hashes: int) -> np.ndarray:
        found = self.slots[:, _slot(grams, 0, self.slots.shape[1])]
        for k in range(1, hashes):
            found &= self.slots[:, _slot(grams, k, self.slots.shape[1])]
        return found


def _slot(grams: np.ndarray, k: int, size: int) -> np.ndarray:
    spread = (grams.astype(np.uint64) + np.uint64(1)) * np.uint64(_SEEDS[k])
    return (spread >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def grams_of(slab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a slab of lower-cased texts, and the places of their second bytes."""
    own = _LETTERS[np.concatenate([slab, [np.uint8(SPACE)] * 2])]
    solid = own != SPACE
    single = solid[1:-2] & ~solid[2:-1] & ~solid[:-3]  # a word of one byte: its end stands twice
    at = np.flatnonzero(solid[1:-2] & (solid[2:-1] | single))
    code = own.astype(np.uint32)
    grams = code[at] | code[at + 1] << np.uint32(8) | code[at + 2] << np.uint32(16)
    return grams | np.where(single[at], np.uint32(SPACE), code[at + 3]) << np.uint32(24), at + 1


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    every, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(every, kind="stable")
    every, counts = every[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(counts, first)


#: Distinct n-grams of a language that a task holds before it passes its counts on.
HELD_GRAMS = 2_000_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each task's own n-gram counts by language."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows(language: str) -> pa.RecordBatch:
        grams, counts = held.pop(language)
        names = pa.array([language], pa.string()).take(pa.array(np.zeros(len(grams), dtype=np.int64)))
        return pa.RecordBatch.from_arrays([names, pa.array(grams.astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        texts, names = byte_texts(batch.column("text")), batch.column("lang").to_pylist()
        by: dict[str, list[bytes]] = {}
        for name, text in zip(names, texts):
            by.setdefault(name, []).append(text)
        for language, own in by.items():
            for slab, *_ in slabs(own, 4 << 20):
                grams, counts = np.unique(grams_of(slab)[0], return_counts=True)
                held[language] = _merged([held[language], (grams, counts)]) if language in held else (grams, counts)
                if len(held[language][0]) > HELD_GRAMS:
                    yield rows(language)
    for language in list(held):
        yield rows(language)


def count_grams(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, n``: every n-gram of every text with a language."""
    known = texts.filter(F.col(lang).isNotNull()).select(F.lower(F.col(text)).alias("text"), F.col(lang).cast("string").alias("lang"))
    return known.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(counts: DataFrame, settings: Settings = Settings()) -> Filters:
    """The filter of the n-grams that each language contains; ``counts`` is read twice."""
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = [(r.lang, r.total) for r in totals.orderBy("lang").limit(settings.most_languages + 1).collect()]
    if len(languages) > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages")
    names = [name for name, _ in languages]
    if not names:
        return Filters([], np.zeros((1, 1), dtype=np.uint64), np.zeros(0))
    known = counts.sparkSession.createDataFrame([(n, i, t) for i, (n, t) in enumerate(languages)], "lang string, place int, total long")
    shares = counts.join(F.broadcast(known), "lang").select("gram", "place", (F.col("n") / F.col("total")).alias("share"))
    shares = shares.filter(F.col("share") >= settings.least_share)
    # At most a row for each language, so collecting an n-gram's rows is bounded.
    best = shares.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("place", "share")).alias("own"))
    contained = F.filter("own", lambda x: x.share >= settings.least_ratio * F.col("best"))
    rows = best.select("gram", F.explode(F.transform(contained, lambda x: x.place)).alias("place")).toPandas()
    return build(names, rows.gram.to_numpy(np.int64), rows.place.to_numpy(np.int64), settings)


def build(names: list[str], grams: np.ndarray, places: np.ndarray, settings: Settings = Settings()) -> Filters:
    size = 1 << max(10, int(settings.slots_per_gram * max(len(np.unique(grams)), 1)).bit_length())
    words = (len(names) - 1) // MASK_BITS + 1
    slots = np.zeros((words, size), dtype=np.uint64)
    bits = np.uint64(1) << (places % MASK_BITS).astype(np.uint64)
    for k in range(settings.hashes):
        np.bitwise_or.at(slots, (places // MASK_BITS, _slot(grams, k, size)), bits)
    filled = [np.mean(slots[p // MASK_BITS] >> np.uint64(p % MASK_BITS) & np.uint64(1)) for p in range(len(names))]
    return Filters(names, slots, np.array(filled) ** settings.hashes)


def decide(texts: list[bytes], filters: Filters, settings: Settings = Settings()) -> tuple[list[str], np.ndarray]:
    """The languages and scores of lower-cased texts."""
    count = len(filters.languages)
    hits, totals = np.zeros((len(texts), max(count, 1))), np.zeros(len(texts), dtype=np.int64)
    for slab, numbers, starts, stops in slabs(texts) if count else ():
        grams, at = grams_of(slab)
        masks = filters.masks(grams, settings.hashes)
        low, high = np.searchsorted(at, starts), np.searchsorted(at, stops)
        np.add.at(totals, numbers, high - low)
        sums = np.zeros(len(grams) + 1, dtype=np.int64)
        for p in range(count):
            np.cumsum(masks[p // MASK_BITS] >> np.uint64(p % MASK_BITS) & np.uint64(1), out=sums[1:])
            np.add.at(hits[:, p], numbers, sums[high] - sums[low])
    true = (hits - totals[:, None] * filters.false_hits) / (1 - filters.false_hits) if count else hits
    best = true.argmax(axis=1)
    scores = np.clip(true[np.arange(len(texts)), best] / np.maximum(totals, 1), 0, 1)
    return [filters.languages[b] if n else UNKNOWN for b, n in zip(best, totals)] if count else [UNKNOWN] * len(texts), scores


def predict(texts: DataFrame, filters: Filters, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Every row's other columns with ``lang_pred`` and ``score`` (replaced if they are there)."""
    shared = texts.sparkSession.sparkContext.broadcast(filters)
    kept = [c for c in texts.columns if c not in ("lang_pred", "score", text)]
    schema = texts.select(*[f"`{c}`" for c in kept]).schema.add("lang_pred", "string").add("score", "double")

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = decide(byte_texts(batch.column(len(kept))), shared.value, settings)
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores)], schema.names)

    return map_batches(with_letters(texts, kept, text), predicted, schema)


def with_letters(texts: DataFrame, kept: list[str], text: str) -> DataFrame:
    """The kept columns and the lower-cased text, empty where it has no letter."""
    own: Column = F.col(f"`{text}`")
    lowered = F.when(own.rlike(r"\p{L}"), F.lower(own)).otherwise("")
    return texts.select(*[F.col(f"`{c}`") for c in kept], lowered.alias("text" + "_" * max(map(len, [*kept, ""]))))
