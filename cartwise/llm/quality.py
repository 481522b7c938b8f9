"""Quality classifier: vectors of hashed words and character n-grams, averaged and put through a softmax.

Features of a text, over its bytes with every white space taken as a space: words, pairs of words (a
pair of equal words is one feature of its own, so repetition is seen whatever the word), and runs of 3 and 4
bytes that touch spaces only at their ends. Each feature is hashed to one of ``BUCKETS`` learned vectors.
The text's vector is the mean over all its features; a softmax over two classes gives the score.

Training takes a bounded sample of labelled rows (``Settings.sample_rows``, those with the smallest hash
of their id), since the vectors are learned by stochastic gradient descent in numpy. One task turns the
sampled texts into feature counts and learns from them, so what it holds is bounded by rows x buckets; the driver
gets the model alone, one number for each bucket. Scoring goes over every whole text in pieces of bounded size.

Defined results: a null or empty text has no feature and gets the score of the bias alone; rows
with a null ``doc_id`` or label are not learned from; without any label, or with one class only,
scores follow the bias, which starts from the add-one share of the classes; repeated rows get the same
score each; other columns are neither read nor changed by the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.arrow import map_batches
from cartwise.llm.slabs import SPACE, byte_texts, mixed, run_hashes, slabs, white_words

BITS = 17
BUCKETS = 1 << BITS
_REPEATED = 1
#: Bytes of texts whose features are counted at a time, one row at least; the counts take about 50 bytes for each.
COUNTED_BYTES = 1 << 18


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 4000
    dimensions: int = 8
    steps: int = 20_000
    rate: float = 2.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """The trained softmax over averaged vectors, folded into one weight for each bucket."""

    weights: np.ndarray
    bias: float

    def score(self, totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + totals / np.maximum(counts, 1), -30, 30)))


def _bucket(codes: np.ndarray, kind: int) -> np.ndarray:
    return ((codes + np.uint32(kind * 0x51ED270B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (text numbers, buckets, starts, stops): the pieces' features, each piece's in a run."""
    for slab, numbers, starts, stops in slabs(texts):
        first, last = white_words(slab)
        flat = slab.copy()
        flat[slab <= 13] = SPACE
        solid = flat != SPACE
        code = flat.astype(np.uint32)
        three = code[:-2] | code[1:-1] << np.uint32(8) | code[2:] << np.uint32(16)
        four = three[:-1] | code[3:] << np.uint32(24)
        del flat, code
        for kind, grams, solids in ((1, three, solid[1:-1]), (2, four, solid[1:-2] & solid[2:-1])):
            at = np.flatnonzero(solids)
            found = numbers, _bucket(grams[at], kind), np.searchsorted(at, starts - 1), np.searchsorted(at, stops - 1)
            del at
            yield found
        del three, four, grams, solid, solids, found
        words = run_hashes(slab, first, last)
        yield numbers, _bucket((words >> np.uint64(32)).astype(np.uint32), 3), np.searchsorted(first, starts), np.searchsorted(first, stops)
        pairs = mixed(words[:-1] * np.uint64(3) + words[1:])
        pairs[words[:-1] == words[1:]] = _REPEATED
        piece = np.searchsorted(starts, first, side="right") - 1
        inside = np.flatnonzero(piece[1:] == piece[:-1])
        places = first[inside]
        yield numbers, _bucket((pairs[inside] >> np.uint64(3)).astype(np.uint32), 4), np.searchsorted(places, starts), np.searchsorted(places, stops)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(batch.num_rows * COUNTED_BYTES // max(batch.nbytes, 1), 1)
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        texts = byte_texts(batch.column("text"))
        found = [[] for _ in texts]
        for numbers, buckets, starts, stops in features(texts):
            for n, a, b in zip(numbers, starts, stops):
                found[n].append(np.unique(buckets[a:b], return_counts=True))
        ids, shares = [], []
        for parts in found:
            sums = np.zeros(0)
            if parts:
                every, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                own, place = np.unique(every, return_inverse=True)
                sums = np.bincount(place, weights=counts, minlength=len(own))
            ids.append((own if len(sums) else np.zeros(0)).astype("<u4").tobytes())
            shares.append((sums / max(sums.sum(), 1)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], ["label", "ids", "shares"])


def sample(labelled: DataFrame, key: str, label: str, settings: Settings) -> DataFrame:
    """At most ``sample_rows`` (key, label) rows, the same ones however the table is partitioned."""
    rows = labelled.select(F.col(key).alias("k"), F.col(label).cast("int").alias("label"))
    rows = rows.filter(F.col("k").isNotNull() & F.col("label").isin(0, 1)).distinct()
    return rows.orderBy(F.xxhash64("k"), "k", "label").limit(settings.sample_rows)


def train(documents: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings()) -> Model:
    """Learn from the texts of ``documents`` whose ids are among the sampled rows of ``labelled``."""
    chosen = F.broadcast(sample(labelled, key, label, settings))  # at most sample_rows rows
    texts = documents.select(F.col(key).alias("k"), F.col(text).alias("text"))
    texts = texts.join(chosen, "k").select("k", "label", "text")
    # A key may repeat in the documents; the bound holds for rows as well.
    texts = texts.orderBy(F.xxhash64("k", "text"), "label").limit(settings.sample_rows).select("label", "text")

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [
            (y, np.frombuffer(i, "<u4"), np.frombuffer(s, "<f4")) for batch in _counted(batches) for y, i, s in zip(*(c.to_pylist() for c in batch.columns))
        ]
        model = fit(examples, settings)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype("<f4").tobytes()]), pa.array([model.bias])], ["weights", "bias"])

    # The task has the rows of the limit. The driver gathers the model, not the examples.
    model = texts.coalesce(1).mapInArrow(learned, "weights binary, bias double").first()
    # Without any row there may be no task.
    return Model(np.frombuffer(model.weights, "<f4"), model.bias) if model else fit([], settings)


def fit(examples: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings = Settings()) -> Model:
    """Softmax over averaged vectors, trained one example at a time with a falling rate."""
    random = np.random.default_rng(settings.seed)
    width = settings.dimensions
    vectors = random.uniform(-1 / width, 1 / width, (BUCKETS, width)).astype(np.float32)
    out = np.zeros((2, width), dtype=np.float32)
    ones = sum(y for y, _, _ in examples)
    bias = np.log(np.array([len(examples) - ones + 1, ones + 1], dtype=np.float64) / (len(examples) + 2))
    examples = sorted(examples, key=lambda e: (e[0], len(e[1]), e[1].tobytes()))  # the order rows came in does not matter
    for step in range(settings.steps if examples else 0):
        if step % len(examples) == 0:
            order = random.permutation(len(examples))
        y, ids, shares = examples[order[step % len(examples)]]
        rate = settings.rate * (1 - step / settings.steps)
        if not len(ids):
            continue
        hidden = shares @ vectors[ids]
        raw = out @ hidden + bias
        likely = np.exp(raw - raw.max())
        likely /= likely.sum()
        likely[y] -= 1
        back = likely.astype(np.float32) @ out
        out -= (rate * likely[:, None] * hidden).astype(np.float32)
        bias -= 0.01 * rate * likely
        vectors[ids] -= rate * shares[:, None] * back
    weights = vectors.astype(np.float64) @ (out[1] - out[0])
    return Model(weights.astype(np.float32), float(bias[1] - bias[0]))


def score(documents: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """Every row of ``documents`` with the probability of label 1 in the column ``into`` (replaced if it is there)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c != into]
    schema = documents.select(*[f"`{c}`" for c in kept]).schema.add(into, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            texts = byte_texts(batch.column(len(kept)))
            totals, counts = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
            for numbers, buckets, starts, stops in features(texts):
                sums = np.zeros(len(buckets) + 1)
                np.cumsum(learned.weights[buckets], dtype=np.float64, out=sums[1:])
                np.add.at(totals, numbers, sums[stops] - sums[starts])
                np.add.at(counts, numbers, stops - starts)
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(learned.score(totals, counts))], [*kept, into])

    own = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("text" + "_" * max(map(len, kept))))
    return map_batches(own, scored, schema)
