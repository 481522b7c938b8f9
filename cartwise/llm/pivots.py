"""Embedding near-duplicates through a pivot-permutation index.

Pivots come from a bounded sample (``Settings.sample`` vectors, those with the smallest hash of their id):
the first ``Settings.pivots`` of it that are not alike, since many pivots inside one dense group would
be put in order by noise. Every vector is described by its ``nearest`` pivots in order of similarity. The index is inverted:
one list for each label and pair of pivots, which holds the vectors that have both among their nearest, so two
vectors meet if they share at least two pivots. Lists are worked off in blocks of bounded size, one task per
pair of blocks; shared pivots are counted, a pair counts in the list of its two smallest shared pivots only, and
its cosine is verified in double precision. Blocks give the number of links of each vector and a link to
the smallest vector it reaches inside the block, never the pairs themselves. Equal vectors are one entry.

Every row is indexed; the sample affects recall alone (see the README for its measure against all pairs).

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a
null label, link with nothing; vectors of different lengths do not link; rows that share an id are one
node; a row with a null id is kept and links with nothing; other columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.components import components
from cartwise.session import materialise


@dataclass(frozen=True)
class Settings:
    sample: int = 2000
    pivots: int = 192
    alike: float = 0.7
    nearest: int = 5
    block: int = 1000


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit rows in double precision; the column's vectors have one length."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _nearest(vectors: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """The numbers of the nearest pivots in order; equal ones by number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :count].astype(np.int32)


def _dissimilar(vectors: np.ndarray, settings: Settings) -> np.ndarray:
    chosen = vectors[:0]
    for v in vectors:
        if len(chosen) < settings.pivots and (chosen @ v <= settings.alike).all():
            chosen = np.vstack([chosen, v])
    return chosen


def postings(entries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Entries (``label, id, copies, vector``) under every pair of their nearest pivots, ``p < q``."""
    sample = entries.orderBy(F.xxhash64("id"), "id").limit(settings.sample).select("vector").toPandas()
    by_length: dict[int, list] = {}
    for v in sample.vector:
        by_length.setdefault(len(v), []).append(v)
    pivots = {n: _dissimilar(_matrix(pa.array(vs)), settings) for n, vs in by_length.items()}
    shared = entries.sparkSession.sparkContext.broadcast(pivots)  # Settings.pivots vectors

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(batch.column("vector").value_lengths())
            for length in np.unique(lengths):
                own = batch.take(pa.array(np.flatnonzero(lengths == length)))
                known = shared.value.get(int(length), np.zeros((0, length)))
                near = _nearest(_matrix(own.column("vector")), known, settings.nearest)
                ordered = np.sort(near, axis=1)
                # Too few pivots of this length: one list holds all.
                pairs = list(combinations(range(near.shape[1]), 2)) or [None]
                for pair in pairs:
                    p, q = (ordered[:, pair[0]], ordered[:, pair[1]]) if pair else (np.full(len(near), -1, np.int32),) * 2
                    listed = pa.array(list(near), pa.list_(pa.int32()))
                    columns = [pa.array(p), pa.array(q), listed]
                    yield pa.RecordBatch.from_arrays([*own.columns, *columns], [*own.schema.names, "p", "q", "near"])

    schema = T.StructType([*entries.schema.fields]).add("p", T.IntegerType()).add("q", T.IntegerType())
    schema = schema.add("near", T.ArrayType(T.IntegerType()))
    return entries.mapInArrow(described, schema)


def blocked(listed: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Postings of lists with at least two entries, a copy for each pair of blocks (``one <= two``) that theirs is in."""
    key = ["label", "length", "p", "q"]
    sized = listed.withColumn("length", F.size("vector"))
    counts = sized.groupBy(*key).agg(F.count("*").alias("entries")).filter("entries > 1")
    parts = F.ceil(F.col("entries") / settings.block).cast("int")
    split = sized.join(counts, key).withColumn("parts", parts).drop("entries")
    split = split.withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return split.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("other", "parts")


def _local_roots(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    roots = np.arange(count)
    while True:
        least = roots.copy()
        np.minimum.at(least, i, roots[j])
        np.minimum.at(least, j, roots[i])
        least = least[least]
        if (least == roots).all():
            return roots
        roots = least


def _verified(p: int, q: int, one: int, two: int, block: pa.Table, threshold: float) -> pa.RecordBatch | None:
    """Link counts and local roots of one pair of blocks."""
    order = np.argsort(block.column("id").to_numpy(), kind="stable")
    block = block.take(pa.array(order)).combine_chunks()
    ids, copies, side = (block.column(c).to_numpy() for c in ("id", "copies", "block"))
    vectors = _matrix(block.column("vector").chunk(0))
    left, right = (np.flatnonzero(side == one), np.flatnonzero(side == two))
    hit = vectors[left] @ vectors[right].T >= threshold
    i, j = np.nonzero(hit)
    i, j = left[i], right[j]
    apart = (i < j) if one == two else (i != j)
    i, j = i[apart], j[apart]
    if not len(i):
        return None
    near = np.sort(block.column("near").chunk(0).flatten().to_numpy().reshape(len(block), -1), axis=1)
    roots = _local_roots(len(ids), i, j)
    counted = np.ones(len(i), dtype=bool)
    if p >= 0:  # the two smallest shared pivots name the list in which the pair counts
        both = (near[i][:, :, None] == near[j][:, None, :]).any(axis=2)
        first = both.argmax(axis=1)
        both[np.arange(len(i)), first] = False
        second = both.argmax(axis=1)
        counted = (near[i, first] == p) & (near[i, second] == q)
    links = np.zeros(len(ids), dtype=np.int64)
    np.add.at(links, i[counted], copies[j[counted]])
    np.add.at(links, j[counted], copies[i[counted]])
    some = np.flatnonzero((links > 0) | (roots != np.arange(len(ids))))
    return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[roots[some]])], ["id", "links", "root"])


def verified(blocks: DataFrame, threshold: float) -> DataFrame:
    """``id, links, root`` from every pair of blocks; each is worked on by one task, whole."""
    key = ["label", "length", "p", "q", "one", "two"]
    columns = [*key, "block", "id", "copies", "vector", "near"]

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                found = _verified(*last[2:], pa.Table.from_batches(held), threshold)
                if found is not None:
                    yield found

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in key])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                now = tuple(int(x) for x in keys[:, start])
                if now != last:
                    yield from flush()
                    held, last = [], now
                held.append(batch.slice(start, stop - start))
        yield from flush()

    ordered = blocks.select(columns).repartition(*key).sortWithinPartitions(*key)
    return ordered.mapInArrow(checked, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, key: str, vector: str, label: str, threshold: float = 0.98, settings: Settings = Settings()) -> DataFrame:
    """``<key>, n_links, component_id, kept``: direct links and the smallest id reachable, for every row."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    good = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    same = {"l": F.xxhash64("label"), "e": F.xxhash64("vector"), "f": F.xxhash64(F.lit(1), "vector")}
    rows = rows.withColumns({n: F.when(good, c) for n, c in same.items()})
    entries = rows.filter(F.col("l").isNotNull()).groupBy("l", "e", "f")
    entries = entries.agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    entries = materialise(entries.withColumnRenamed("l", "label"), "entries")
    found = materialise(verified(blocked(postings(entries, settings), settings), threshold), "verified")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = entries.select("label", "e", "f", "id", "copies").join(links, "id", "left")
    classes = classes.join(reached, classes.id == reached.node, "left").select(
        F.col("label").alias("l"),
        "e",
        "f",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    out = rows.join(classes, ["l", "e", "f"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
