"""k-means on weighted points: Lloyd steps from a start that the data fix.

A step is one pass over the cached points for all fits that still move: every task adds up its points by nearest centre in numpy and
returns one row for each centre, which Spark adds up. Centres go in as data, so the plan and its compiled code are the same at every step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.operators.quantiles import exact_quantiles
from cartwise.operators.scaling import inertia_of_one
from cartwise.operators.silhouette import silhouette_squared, silhouettes_euclidean
from cartwise.session import materialise

MAX_ITER = 300
TOLERANCE = 1e-4
DIGITS = 9
LABEL, WEIGHT = "cluster", "_weight"
#: Distances held at a time.
HELD = 2_000_000

Centers = list[tuple[float, ...]]


def weighted_points(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct points with their number of rows. The objective stays the same."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))


def nearest_center(columns: list[str], centers: list[tuple[float, ...]]) -> Column:
    """Number of the nearest centre; the lower number wins a tie."""
    distances = []
    for i, center in enumerate(centers):
        squares = [(F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(columns, center)]
        distances.append(F.struct(reduce(lambda a, b: a + b, squares).alias("distance"), F.lit(i).alias("number")))
    return (F.least(*distances) if len(distances) > 1 else distances[0])["number"]


@dataclass
class Clustering:
    """A fitted clustering; clusters are numbered by the order of their centres."""

    centers: list[tuple[float, ...]]
    columns: list[str]
    inertia: float

    def label(self, df: DataFrame, name: str = LABEL) -> DataFrame:
        """``df`` with the cluster number of every row; all columns are kept.

        Plain column arithmetic: no vector is built and no partner is joined.
        """
        return df.withColumn(name, nearest_center(self.columns, self.centers))


def start_centers(points: DataFrame, columns: list[str], ks: list[int]) -> dict[int, list[tuple[float, ...]]]:
    """For every k the k points at the middles of k equal shares of each column: fixed by the data alone."""
    shares = sorted({(i + 0.5) / k for k in ks for i in range(k)})
    found = exact_quantiles(points, columns, shares)
    at = {p: tuple(found[c][i] for c in columns) for i, p in enumerate(shares)}
    return {k: [at[(i + 0.5) / k] for i in range(k)] for k in ks}


def _distance(columns: list[str], centers: list[tuple[float, ...]]) -> Column:
    """Squared distance to the nearest centre."""
    squares = [reduce(lambda a, b: a + b, [(F.col(c) - F.lit(x)) ** 2 for c, x in zip(columns, m)]) for m in centers]
    return F.least(*squares) if len(squares) > 1 else squares[0]


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each point's nearest centre (the lower one of a tie) and its squared distance; ``x`` has a row for each column."""
    squares = np.zeros((len(centers), x.shape[1]))
    for own, center in zip(x, centers.T):
        difference = own - center[:, None]
        squares += difference * difference
    number = squares.argmin(axis=0)
    return number, squares[number, np.arange(x.shape[1])]


def _totals(points: DataFrame, columns: list[str], centers: dict[int, Centers]) -> DataFrame:
    """``k, number, w, inertia, s0, s1, ...`` for every centre that has points: their weight, weighted distance and weighted sums."""
    known = {k: np.array(m, dtype=float) for k, m in centers.items()}
    names = ["w", "inertia", *[f"s{j}" for j in range(len(columns))]]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((len(names), len(m))) for k, m in known.items()}
        for batch in batches:
            x = np.stack([batch.column(j).to_numpy(zero_copy_only=False) for j in range(len(columns))])
            w = batch.column(len(columns)).to_numpy(zero_copy_only=False)
            for k, m in known.items():
                step = max(1, HELD // len(m))
                for low in range(0, len(w), step):
                    own, weight = x[:, low : low + step], w[low : low + step]
                    number, squares = _nearest(own, m)
                    for total, value in zip(totals[k], [weight, weight * squares, *(weight * own)]):
                        total += np.bincount(number, value, minlength=len(m))
        ks = np.repeat(list(known), [len(m) for m in known.values()])
        numbers = np.concatenate([np.arange(len(m)) for m in known.values()])
        sums = np.concatenate(list(totals.values()), axis=1)
        some = sums[0] > 0
        yield pa.RecordBatch.from_arrays([pa.array(v[some]) for v in (ks, numbers, *sums)], ["k", "number", *names])

    schema = "k long, number long, " + ", ".join(f"{n} double" for n in names)
    parts = points.select(*[F.col(c).cast("double") for c in columns], F.col(WEIGHT).cast("double")).mapInArrow(added, schema)
    return parts.groupBy("k", "number").agg(*[F.sum(n).alias(n) for n in names])


def _moved(points: DataFrame, columns: list[str], centers: dict[int, Centers]) -> dict[int, Centers]:
    """The weighted mean of every centre's points, to nine digits; a centre without points goes to a farthest point.

    Means are rounded, so that the order of additions, and with it the partitioning, does not show.
    """
    means = [F.round(F.col(f"s{j}") / F.col("w"), DIGITS).alias(c) for j, c in enumerate(columns)]
    now: dict[int, dict[int, tuple]] = {k: {} for k in centers}
    for r in _totals(points, columns, centers).select("k", "number", *means).collect():  # a row for each centre
        now[r.k][r.number] = tuple(r[c] for c in columns)
    for k, own in now.items():
        empty = [i for i in range(len(centers[k])) if i not in own]
        if empty and own:
            far = points.orderBy(_distance(columns, list(own.values())).desc(), *columns).limit(len(empty)).collect()
            own |= {i: tuple(float(r[c]) for c in columns) for i, r in zip(empty, far)}
    return {k: [now[k].get(i, center) for i, center in enumerate(own)] for k, own in centers.items()}


def fit(points: DataFrame, columns: list[str], k: int) -> Clustering:
    """Fit k clusters on weighted points (see ``weighted_points``)."""
    return fit_many(points, columns, [k])[k]


def fit_many(points: DataFrame, columns: list[str], ks: list[int]) -> dict[int, Clustering]:
    """One clustering per k, all of them in the same passes, each until no centre moves farther than the tolerance.

    The points are cached once for all steps. A lost block is read again from the written table.
    """
    centers = start_centers(points, columns, ks)
    own = points.select(*columns, WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        moving = dict(centers)
        for _ in range(MAX_ITER):
            moved = _moved(own, columns, moving)
            centers |= moved
            moving = {k: m for k, m in moved.items() if max(math.dist(a, b) for a, b in zip(moving[k], m)) > TOLERANCE}
            if not moving:
                break
        inertia = _totals(own, columns, centers).groupBy("k").agg(F.sum("inertia").alias("inertia"))
        found = {r.k: float(r.inertia) for r in inertia.collect()}
    finally:
        own.unpersist()
    return {k: Clustering(sorted(centers[k]), columns, found[k]) for k in ks}


def elbow(points: DataFrame, columns: list[str], models: dict[int, Clustering]) -> list[tuple[int, float]]:
    """(k, inertia), with k = 1 from one aggregate."""
    one = inertia_of_one(points, columns, WEIGHT).first().inertia
    return [(1, float(one)), *[(k, m.inertia) for k, m in sorted(models.items())]]


def silhouettes(points: DataFrame, columns: list[str], models: dict[int, Clustering], squared: bool = False) -> dict[int, float]:
    """k -> silhouette for every model, Euclidean or squared Euclidean."""
    labels = {k: f"{LABEL}_{k}" for k in sorted(models)}
    labelled = points
    for k, name in labels.items():
        labelled = models[k].label(labelled, name)
    labelled = materialise(labelled, "labelled-points")
    if squared:
        return {k: silhouette_squared(labelled, columns, n, WEIGHT).first().silhouette for k, n in labels.items()}
    scores = {r.label: r.silhouette for r in silhouettes_euclidean(labelled, columns, list(labels.values()), WEIGHT).collect()}
    return {k: scores[n] for k, n in labels.items()}
