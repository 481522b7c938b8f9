"""Nearest-neighbour imputation as a sequence of joins.

A missing value becomes the mean of the k nearest rows that have it. The distance
is Euclidean over the coordinates present in both rows, scaled by total/present.
Pairing every row that lacks a value with every row that has it would be
quadratic. Instead:

1. Rows with the same coordinates are one point. A point needs at most its k first
   donors (by row key), since further ones can never be among the k nearest.
2. Donors are parted by a k-d tree: Spark cuts every cell of too many donors at quantiles of
   its widest axis, all cells of a level in one pass, until a cell has ``LEAF`` donors at most. A
   far outlier takes a cell of its own and squeezes no others. Each cell has the box its points really span.
3. Every receiver point walks down the tree and drops each cell that is farther
   than the distance within which it already has k donors. The leaves that remain are compared point by point.

The result is the exact one; ties go to the smaller row key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.session import materialise

#: Most donors of a leaf (or k, if that is more).
LEAF = 64
#: Parts that the quantiles of a cell make.
PARTS = 16
#: The cuts need no exact rank, since a cell that is still too large is cut again.
ACCURACY = 1_000


def knn_impute(df: DataFrame, key: str, features: list[str], k: int = 2) -> DataFrame:
    """``df`` with the nulls of ``features`` filled; other columns are kept.

    ``df`` is read several times: hand in a written table.
    """
    patterns = _null_patterns(df, features)
    # The features as they came, since distances never use a filled value.
    result = df.withColumns({_raw(c): F.col(c) for c in features})
    for target in features:
        if any(target not in p for p in patterns) and any(target in p for p in patterns):
            result = _fill(result, target, features, _estimates(df, key, features, target, patterns, k), df)
    return result.drop(*[_raw(c) for c in features])


def _raw(column: str) -> str:
    return f"_raw_{column}"


def _null_patterns(df: DataFrame, features: list[str]) -> list[tuple[str, ...]]:
    """Which feature sets occur as present; at most 2^features rows."""
    present = [F.when(F.col(c).isNotNull(), F.lit(c)) for c in features]
    rows = df.select(F.array_compact(F.array(*present)).alias("p")).distinct().collect()
    return [tuple(r.p) for r in rows]


def _has_pattern(features: list[str], pattern: tuple[str, ...]) -> Column:
    condition = F.lit(True)
    for c in features:
        condition = condition & (F.col(c).isNotNull() if c in pattern else F.col(c).isNull())
    return condition


def _estimates(source: DataFrame, key: str, features: list[str], target: str, patterns: list, k: int) -> DataFrame | None:
    """Estimate of ``target`` per distinct point that lacks it; None when no row can be compared."""
    others = [c for c in features if c != target]
    result = None
    for receiver in [p for p in patterns if p and target not in p]:
        receivers = source.where(_has_pattern(features, receiver)).select(*[F.col(c).cast("double") for c in receiver]).distinct()
        found = []
        for donor in [p for p in patterns if target in p]:
            shared = [c for c in receiver if c in donor]
            if not shared:
                continue
            donors = source.where(_has_pattern(features, donor)).select(
                F.col(key).alias("donor"),
                F.col(target).cast("double").alias("value"),
                *[F.col(c).cast("double") for c in shared],
            )
            near = nearest(receivers.select(*shared).distinct(), donors, shared, k)
            near = near.withColumn("distance", F.col("distance") * (len(features) / len(shared)))
            if len(shared) == len(receiver):
                pairs = near.withColumnsRenamed({f"q_{c}": c for c in shared})
            else:
                pairs = receivers.join(near, [F.col(c) == F.col(f"q_{c}") for c in shared])
            found.append(pairs.select(*receiver, "donor", "value", "distance"))
        if not found:
            continue
        candidates = found[0]
        if len(found) > 1:
            # Each donor pattern gave its k nearest; the k nearest of all are among them.
            order = W.partitionBy(*receiver).orderBy("distance", "donor")
            candidates = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
            candidates = candidates.where(F.col("rank") <= k)
        point = [F.col(c) if c in receiver else F.lit(None).cast("double").alias(c) for c in others]
        estimate = candidates.groupBy(*receiver).agg(F.avg("value").alias("estimate")).select(*point, "estimate")
        result = estimate if result is None else result.unionByName(estimate)
    return result


def _fill(result: DataFrame, target: str, features: list[str], estimates: DataFrame | None, source: DataFrame) -> DataFrame:
    """Rows that have the target pass by; the others take the estimate of their point, or the mean."""
    lacking = result.where(F.col(_raw(target)).isNull())
    value = source.agg(F.avg(target)).scalar()
    if estimates is not None:
        points = estimates.withColumnsRenamed({c: f"_at_{c}" for c in features})
        same = [F.col(_raw(c)).cast("double").eqNullSafe(F.col(f"_at_{c}")) for c in features if c != target]
        lacking = lacking.join(points, same, "left")
        value = F.coalesce(F.col("estimate"), value)
    value = value.cast(result.schema[target].dataType).alias(target)
    lacking = lacking.select(*[value if c == target else F.col(c) for c in result.columns])
    return result.where(F.col(_raw(target)).isNotNull()).unionByName(lacking)


def nearest(queries: DataFrame, donors: DataFrame, axes: list[str], k: int) -> DataFrame:
    """The k nearest donors of every query point: (q_<axis>..., donor, value, distance squared).

    ``queries`` holds distinct points on ``axes``; ``donors`` has (donor, value, axes).
    """
    # The rank filter is applied before the shuffle too, so a point shared by very
    # many donors sends only k rows per task.
    order = W.partitionBy(*axes).orderBy("donor")
    kept = donors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")
    cells, placed = partition(kept, axes, max(LEAF, k))

    point = [f"q_{a}" for a in axes]
    near, far = F.lit(0.0), F.lit(0.0)
    for a in axes:
        q, lo, hi = F.col(f"q_{a}"), F.col(f"min_{a}"), F.col(f"max_{a}")
        gap = F.greatest(lo - q, q - hi, F.lit(0.0))
        span = F.greatest(F.abs(lo - q), F.abs(q - hi))
        near, far = near + gap * gap, far + span * span
    # Every query starts at all children of the root, 2 * PARTS at most, or at a root that is a leaf.
    start = F.array(*[F.lit(r.cell) for r in cells[:2][-1].select("cell").collect()]).cast("array<string>")
    frontier = queries.select(*[F.col(a).alias(f"q_{a}") for a in axes], F.explode(start).alias("at"))
    leaves = None
    for i, level in enumerate(cells[:2][-1:] + cells[2:]):
        seen = frontier.join(level.withColumn("at", F.col("parent" if i else "cell")), "at")
        seen = seen.select(*point, "cell", "n", "leaf", near.alias("near"), far.alias("far"))
        if leaves is not None:
            seen = seen.unionByName(leaves)
        # Smallest distance within which k donors are certain.
        by_far = W.partitionBy(*point).orderBy("far").rangeBetween(W.unboundedPreceding, W.currentRow)
        seen = seen.withColumn("within", F.sum("n").over(by_far))
        reach = F.min(F.when(F.col("within") >= k, F.col("far"))).over(W.partitionBy(*point))
        seen = seen.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("near") <= F.col("reach")))
        seen = materialise(seen.select(*point, "cell", "n", "leaf", "near", "far"), "knn-frontier")
        frontier, leaves = seen.where("NOT leaf").select(*point, F.col("cell").alias("at")), seen.where("leaf")

    distance = F.lit(0.0)
    for a in axes:
        distance = distance + (F.col(f"q_{a}") - F.col(a)) * (F.col(f"q_{a}") - F.col(a))
    pairs = leaves.select(*point, "cell").join(placed, "cell").withColumn("distance", distance)
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy(*point).orderBy("distance", "donor")))
    return ranked.where(F.col("rank") <= k).select(*point, "donor", "value", "distance")


def partition(donors: DataFrame, axes: list[str], most: int) -> tuple[list[DataFrame], DataFrame]:
    """The cells by level, from the root down, and the donors with their leaf (``cell``).

    A cell: ``cell, parent, n, leaf`` and the box of its donors. A leaf has at most ``most`` donors, which needs
    that no point has more.
    """
    rest = materialise(donors.withColumns({"cell": F.lit("0"), "parent": F.lit("")}), "knn-donors")
    cuts = [i / PARTS for i in range(1, PARTS)]
    levels, leaves = [], []
    while True:
        boxes = [f(F.col(a)).alias(f"{side}_{a}") for a in axes for side, f in (("min", F.min), ("max", F.max))]
        cells = rest.groupBy("cell", "parent").agg(F.count(F.lit(1)).alias("n"), *boxes).withColumn("leaf", F.col("n") <= most)
        cells = materialise(cells, "knn-cells")
        levels.append(cells)
        widths = F.array(*[F.col(f"max_{a}") - F.col(f"min_{a}") for a in axes])
        widest = F.array_position(widths, F.array_max(widths)).cast("int").alias("axis")
        marked = rest.drop("parent").join(cells.select("cell", "leaf", widest), "cell")
        leaves.append(marked.where("leaf").drop("leaf", "axis"))
        if cells.where("NOT leaf").isEmpty():
            return levels, reduce(DataFrame.unionByName, leaves)
        opened = marked.where("NOT leaf").withColumn("along", F.element_at(F.array(*axes), F.col("axis")))
        edges = opened.groupBy("cell").agg(F.percentile_approx("along", cuts, ACCURACY).alias("edges"))
        cut = opened.join(materialise(edges, "knn-edges"), "cell")
        # Values below, at and above an edge part, so that every cut of two different values makes smaller cells.
        part = F.size(F.filter("edges", lambda e: e < F.col("along"))) + F.size(F.filter("edges", lambda e: e <= F.col("along")))
        child = F.concat_ws(".", "cell", part.cast("string"))
        rest = cut.select(*donors.columns, child.alias("cell"), F.col("cell").alias("parent"))
        rest = materialise(rest, "knn-donors")
