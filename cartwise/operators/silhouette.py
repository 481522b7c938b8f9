"""Mean silhouette of a labelled table.

``silhouette_squared`` uses squared distances, whose mean to a cluster follows from
the cluster's size, sum and sum of squares; it is linear in the rows.
``silhouette_euclidean`` uses plain distances. At a tolerance of 0, the default, every pair of points counts with its
distance: Spark deals the distinct points into shares of points that stand together, and every cell of points meets
every share. Pairs that stand near each other are taken one by one, far ones by interpolation that is off by 1e-10 of
each distance at most (``distance_sums``), which ``lower`` and ``upper`` allow for. Above 0, points go down the trees of the clusters (``distance_tree``), whose
limits settle far nodes as a whole. Nothing is sampled. A null label is a cluster of its own; coordinates are finite numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.operators import distance_sums, distance_tree
from cartwise.session import materialise

#: Most points of a box that is not opened further, and such boxes of a cell.
POINTS = 512
BOXES = 32
#: Points of a task's own that meet one at a time: their distances stay in a core's cache.
ROWS = 64
#: Most points of a task's own, and sums of theirs that it holds.
OWN = 1 << 16
STATE = 1 << 22
#: Distances held at a time.
HELD = 2_000_000
#: Both limits leave room for the rounding of sums.
ROUNDING = 1e-12


def _weight(weight: str | None) -> Column:
    return F.col(weight).cast("double") if weight else F.lit(1.0)


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _score(a: np.ndarray, b: np.ndarray, alone: np.ndarray) -> np.ndarray:
    top = np.maximum(a, b)
    found = np.divide(b - a, top, out=np.zeros_like(top), where=top > 0)
    return np.where(alone | ~np.isfinite(found), 0.0, found)


def _coded(df: DataFrame, label: str, clusters: list, code: str) -> DataFrame:
    """With the place of the row's label in ``clusters``."""
    schema = df.select(F.col(label).alias(f"{code} label"), F.lit(0).alias(code)).schema
    codes = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(clusters)], schema)
    return df.join(F.broadcast(codes), F.col(label).eqNullSafe(F.col(f"{code} label"))).drop(f"{code} label")


def silhouette_squared(df: DataFrame, columns: list[str], label: str, weight: str | None = None) -> DataFrame:
    """(n, silhouette) with squared Euclidean distance; a cluster of one counts 0."""
    w = _weight(weight)
    norm = _total([F.col(c) * F.col(c) for c in columns])
    clusters = df.groupBy(label).agg(
        F.sum(w).alias("n"), F.sum(w * norm).alias("q"), *[F.sum(w * F.col(c)).alias(f"s_{c}") for c in columns]
    ).collect()
    n, q = (np.array([c[name] for c in clusters], dtype=float) for name in ("n", "q"))
    sums = np.array([[c[f"s_{name}"] for name in columns] for c in clusters], dtype=float).reshape(-1, len(columns))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, HELD // max(len(n), 1))
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                x, own, weights = part.iloc[:, 2:].to_numpy(float), part["code"].to_numpy(), part["w"].to_numpy(float)
                distance = np.maximum(n * (x * x).sum(axis=1)[:, None] - 2 * x @ sums.T + q, 0.0)
                pick = np.arange(len(part)), own
                alone = n[own] <= 1
                a = distance[pick] / np.where(alone, 1, n[own] - 1)
                distance /= n
                distance[pick] = np.inf
                yield pd.DataFrame({"w": [weights.sum()], "score": [(weights * _score(a, distance.min(axis=1), alone)).sum()]})

    own = _coded(df.select(w.alias("w"), F.col(label).alias("label"), *[F.col(c).cast("double").alias(f"x_{c}") for c in columns]), "label", [c[0] for c in clusters], "code")
    parts = own.select("w", "code", *[f"x_{c}" for c in columns]).mapInPandas(scored, "w double, score double")
    return parts.agg(F.sum("w").cast("long").alias("n"), (F.sum("score") / F.sum("w")).alias("silhouette"))


def silhouette_euclidean(
    df: DataFrame, columns: list[str], label: str, weight: str | None = None, max_cells: int | None = None, tolerance: float = 0.0
) -> DataFrame:
    """(n, silhouette, lower, upper) with Euclidean distance; a cluster of one counts 0.

    The true score lies between ``lower`` and ``upper``, which are at most ``tolerance`` apart
    and ``silhouette`` is the middle. At 0 no pair is left out, and the limits are 5e-10 apart at most. ``max_cells`` asks for larger or
    smaller boxes, of ``POINTS`` points at most. It changes the work, not what the tolerance allows.
    """
    return silhouettes_euclidean(df, columns, [label], weight, max_cells, tolerance).drop("label")


def silhouettes_euclidean(
    df: DataFrame, columns: list[str], labels: list[str], weight: str | None = None, max_cells: int | None = None, tolerance: float = 0.0
) -> DataFrame:
    """One row per label column: the same distances serve every labelling of the points."""
    points = materialise(df.groupBy(*columns, *labels).agg(F.sum(_weight(weight)).alias("w")), "silhouette-points")
    if tolerance > 0:
        return _within(points, columns, labels, tolerance)
    sizes = []
    for i, label in enumerate(labels):
        found = points.groupBy(label).agg(F.sum("w")).collect()  # one row for each cluster
        if len(found) < 2:
            raise ValueError("a silhouette needs 2 clusters")
        sizes.append(np.array([r[1] for r in found], dtype=float))
        points = _coded(points, label, [r[0] for r in found], f"code {i}")
    held, count = max(1, min(OWN, STATE // sum(map(len, sizes)))), points.count()
    some = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(count / held))
    most = max(1, min(POINTS, count // max_cells if max_cells else POINTS))
    cells = _cells(points, columns, len(labels), some, most)
    # All pairs of points, on purpose: a task has a share of them, its own, which meets a copy of every cell, so their sums are whole.
    own = cells.select("share", F.lit(True).alias("mine"), "x", "w", "codes")
    copies = cells.select(F.explode(F.sequence(F.lit(0), F.lit(some - 1))).alias("share"), F.lit(False).alias("mine"), "x", "w", "codes")
    met = own.unionByName(copies).repartitionById(some, F.col("share")).sortWithinPartitions("share", F.desc("mine"))
    return _summed(met.mapInPandas(_scorer(labels, sizes, len(columns), most, ROWS), "label string, w double, low double, high double"))


def _summed(parts: DataFrame) -> DataFrame:
    low, high = (F.sum(c) / F.sum("w") for c in ("low", "high"))
    return parts.groupBy("label").agg(
        F.sum("w").cast("long").alias("n"),
        ((low + high) / 2).alias("silhouette"),
        (low - ROUNDING).alias("lower"),
        (high + ROUNDING).alias("upper"),
    )


def _within(points: DataFrame, columns: list[str], labels: list[str], tolerance: float) -> DataFrame:
    """Every labelling's score by the trees of its clusters."""
    axes, d = [f"x{i}" for i in range(len(columns))], len(columns)
    place = [F.col(c).cast("double").alias(a) for a, c in zip(axes, columns)]
    each = F.array(*[F.struct(F.lit(i).alias("lab"), F.col(c).cast("string").alias("of")) for i, c in enumerate(labels)])
    long = points.select(*place, "w", F.explode(each).alias("l"))
    tree = F.concat(F.col("l.lab"), F.when(F.col("l.of").isNull(), "").otherwise(F.concat(F.lit("="), "l.of")))
    # With one labelling the points of a tree are distinct already; with more, other labels have split them.
    long = long.groupBy(F.col("l.lab").alias("lab"), tree.alias("tree"), *axes).agg(F.sum("w").alias("w"))
    roots, families, blocks = distance_tree.build(materialise(long, "silhouette-long"), axes)
    if roots.groupBy("lab").count().filter("count < 2").count():
        raise ValueError("a silhouette needs 2 clusters")
    # With every mean distance known within this factor, ln(b / a) is within its square's logarithm, and the score within that.
    means = distance_tree.mean_distances(roots, families, blocks, d, math.exp(tolerance / 2))
    own = blocks.select("q", F.lit(True).alias("mine"), F.lit(0.0).alias("size"), "data", "lab")
    rows = own.unionByName(means.select("q", "mine", "size", "data", F.lit(None).cast("int").alias("lab")))
    parts = max(points.sparkSession.sparkContext.defaultParallelism, rows.count() // distance_tree.ROWS)
    rows = rows.repartition(parts, "q").sortWithinPartitions("q", F.col("lab").isNull(), F.desc("mine"))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A block's row comes first, then its own cluster's, then those that may be the nearest."""
        sums = {i: np.zeros(3) for i in range(len(labels))}
        block: dict = {}

        def closed() -> None:
            if block:
                w, (a_low, a_high), (b_low, b_high), alone = block["w"], block["a"], block["b"], block["alone"]
                low, high = _score(a_high, b_low, alone), _score(a_low, b_high, alone)
                sums[block["lab"]] += w.sum(), (w * low).sum(), (w * high).sum()

        for batch in batches:
            for lab, mine, size, data in batch[["lab", "mine", "size", "data"]].itertuples(index=False, name=None):
                if not pd.isna(lab):
                    closed()
                    w = np.asarray(data).reshape(-1, d + 1)[:, d]
                    block = {"lab": int(lab), "w": w, "b": np.full((2, len(w)), np.inf)}
                    continue
                limits = np.asarray(data).reshape(2, -1)
                if mine:
                    block["alone"] = np.full(limits.shape[1], size <= 1)
                    block["a"] = limits * (1.0 if size <= 1 else size / (size - 1))
                else:
                    block["b"] = np.minimum(block["b"], limits)
        closed()
        found = [(labels[i], *s) for i, s in sums.items() if s[0]]
        yield pd.DataFrame(found, columns=["label", "w", "low", "high"])

    return _summed(rows.mapInPandas(scored, "label string, w double, low double, high double"))


def _cells(points: DataFrame, columns: list[str], labels: int, some: int, most: int) -> DataFrame:
    """``share, x, w, codes``: shares of points that stand together, along a curve that fills their box, in cells, packed."""
    codes = [f"code {i}" for i in range(labels)]
    d = len(columns)
    axes = [f"x_{i}" for i in range(d)]
    own = points.select(*[F.col(c).cast("double").alias(a) for a, c in zip(axes, columns)], "w", *[F.col(f"`{c}`") for c in codes])
    ends = own.agg(*[f(a).alias(f"{n}_{a}") for a in axes for n, f in (("low", F.min), ("high", F.max))]).first()
    low = np.array([ends[f"low_{a}"] for a in axes], dtype=float)
    side = np.nanmax([0.0, *(np.array([ends[f"high_{a}"] for a in axes], dtype=float) - low)]) or 1.0
    bits = max(1, min(50, 60 // d))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.nan_to_num((batch.iloc[:, :d].to_numpy(float) - low) / side)[:, :60]
            at = np.clip(x * 2.0**bits, 0, 2.0**bits - 1).astype(np.int64)
            parts = [((at[:, j] >> bit) & 1) << (bit * at.shape[1] + j) for bit in range(bits) for j in range(at.shape[1])]
            yield batch.assign(place=np.bitwise_or.reduce(parts))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = [*batches]
        if not any(map(len, every)):
            return
        task = pd.concat(every, ignore_index=True)
        x, w = task.iloc[:, :d].to_numpy(float), task["w"].to_numpy(float)
        code = task.iloc[:, d + 1 : -1].to_numpy(np.int32)
        order, boxes = distance_sums.tree(x, most * BOXES)
        leaves = [order[start:stop] for start, stop, opened, _ in boxes if not opened]
        share = TaskContext.get().partitionId()
        yield pd.DataFrame([(share, x[i].tobytes(), w[i].tobytes(), code[i].tobytes()) for i in leaves], columns=["share", "x", "w", "codes"])

    # Points of one place are told apart by a hash, so that no share grows with them.
    ranged = own.mapInPandas(placed, own.withColumn("place", F.lit(0).cast("long")).schema).repartitionByRange(some, "place", F.xxhash64(*axes))
    return materialise(ranged.mapInPandas(packed, "share int, x binary, w binary, codes binary"), "silhouette-cells")


def _scorer(labels: list[str], sizes: list[np.ndarray], d: int, most: int, rows: int):
    """Per share and labelling, once its own points met all cells: the weighted sums of the scores, as both limits."""
    offsets = np.cumsum([0, *map(len, sizes)])

    def unpacked(x: bytes, w: bytes, codes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(x).reshape(-1, d), np.frombuffer(w), np.frombuffer(codes, dtype=np.int32).reshape(-1, len(labels))

    def add(sums: distance_sums.Sums, y: np.ndarray, v: np.ndarray, codes: np.ndarray) -> None:
        """To every labelling's sums, those of the distances to the points y; with very many clusters, to some of them at a time."""
        places = codes + offsets[:-1]
        clusters, at = np.unique(places, return_inverse=True)
        if len(y) > most and len(y) * len(clusters) > STATE:
            for part in (slice(None, len(y) // 2), slice(len(y) // 2, None)):
                add(sums, y[part], v[part], codes[part])
            return
        weights = np.zeros((len(y), len(clusters)))
        np.put_along_axis(weights, at.reshape(places.shape), v[:, None], axis=1)
        sums.meet(y, weights, clusters)

    def scores(sums: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
        pick, alone = (np.arange(len(own)), own), size[own] <= 1
        a = sums[pick] / np.where(alone, 1, size[own] - 1)
        means = sums / size
        means[pick] = np.inf
        return _score(a, means.min(axis=1), alone)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at, sums = None, None

        def closed() -> pd.DataFrame:
            w, codes = (np.concatenate([o[i] for o in own]) for i in (1, 2))
            totals, off = sums.totals(), 2 * sums.error * w.sum()  # of either mean in their quotient
            found = []
            for name, a, b, size, code in zip(labels, offsets, offsets[1:], sizes, codes.T):
                total = (w * scores(totals[:, a:b], size, code)).sum()
                found.append([name, w.sum(), total - off, total + off])
            return pd.DataFrame(found, columns=["label", "w", "low", "high"])

        for batch in batches:
            for share, mine, *cell in batch[["share", "mine", "x", "w", "codes"]].itertuples(index=False, name=None):
                if share != at:
                    if own:
                        yield closed()
                    at, own, sums = share, [], None
                if mine:
                    own.append(unpacked(*cell))
                elif own:
                    if sums is None:
                        sums = distance_sums.Sums(np.concatenate([o[0] for o in own]), offsets[-1], most, rows)
                    add(sums, *unpacked(*cell))
        if own:
            yield closed()

    return run
