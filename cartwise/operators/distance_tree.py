"""Mean distances from points to clusters, within a relative tolerance, without meeting all pairs.

Every cluster has a tree of cubes over its points, built level by level in Spark: a node keeps
weight, mean, covariance and the sphere around its mean. Blocks of points go down the trees. A
node's mean distance to a point lies between two limits:

* the distance to the node's mean (Jensen) and the root mean squared distance;
* outside the sphere, the second-order expansion around the mean and its largest remainder.

A node is settled for a block where both limits are closer than the tolerance allows, measured at
the mean distance to the whole cluster; only the others are opened, by an equi-join
with their children. A cluster that cannot be the nearest one of a block is left. Leaves are met point by point.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.session import materialise

#: Most distinct points of a leaf; below the last level, of a piece of one.
LEAF = 64
#: Halvings of the widest axis. Points of one cube below that are dealt into pieces.
LEVELS = 30
#: Distances held at a time.
HELD = 1_000_000
#: Rows that meet in one task.
ROWS = 50_000
#: The third derivative of a distance r along a line is 2 / sqrt(3) / r^2 at most; a sixth of it bounds the remainder.
REMAINDER = 1 / (3 * 3**0.5)
#: Kinds of rows that meet in a block's group, in the order in which they are read.
BLOCK, STATE, NODES, POINTS = range(4)
MEETING = "q long, tree string, kind int, ids array<string>, leaf array<boolean>, data array<double>, size double, mine boolean, best double"
MET = "q long, tree string, state boolean, id string, leaf boolean, data array<double>, size double, mine boolean, best double, done boolean, least double, most double"


def _id(level: int, places: list[Column]) -> Column:
    return F.concat_ws(" ", "tree", F.lit(level), *[p.cast("string") for p in places])


def build(points: DataFrame, axes: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(roots, families, blocks) of the trees of ``points``: lab, tree, the axes, w; one row for each distinct point of a tree.

    ``roots``: lab, tree, size, id, leaf. ``families``: id, ids, leaf, data, the children of a node.
    ``blocks``: id, lab, tree, q, data, the points of a leaf.
    """
    ends = points.agg(*[f(a).alias(f"{n}_{a}") for a in axes for n, f in (("low", F.min), ("high", F.max))]).first()
    low = {a: ends[f"low_{a}"] or 0.0 for a in axes}
    side = max((ends[f"high_{a}"] or 0.0) - low[a] for a in axes) or 1.0
    rest, nodes, leaves = points, [], []
    for level in range(LEVELS + 1):
        cells = 2.0**level
        places = [F.least(F.floor((F.col(a) - low[a]) / side * cells), F.lit(int(cells) - 1)).alias(f"p_{a}") for a in axes]
        placed = rest.withColumns({f"p_{a}": p for a, p in zip(axes, places)}).withColumn("id", _id(level, [F.col(f"p_{a}") for a in axes]))
        found = materialise(_nodes(placed, axes, low, side, level), "tree-nodes")
        nodes.append(found)
        last = level == LEVELS
        marked = placed.drop(*[f"p_{a}" for a in axes]).join(found.select("id", "points", "is_leaf"), "id")
        marked = materialise(marked, "tree-points")
        leaves.append(marked.filter("is_leaf"))
        rest = marked.filter("NOT is_leaf").drop("id", "points", "is_leaf")
        if last or rest.isEmpty():
            break
    all_nodes = reduce(DataFrame.unionByName, nodes)
    roots = nodes[0].select("lab", "tree", F.col("weight").alias("size"), "id", F.col("is_leaf").alias("leaf"))
    families = all_nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.collect_list(F.struct("id", "is_leaf", "data")).alias("f"))
    families = families.select(F.col("parent").alias("id"), F.col("f.id").alias("ids"), F.col("f.is_leaf").alias("leaf"), F.flatten("f.data").alias("data"))
    pieces = F.ceil(F.col("points") / LEAF)
    dealt = reduce(DataFrame.unionByName, leaves).withColumn("piece", F.pmod(F.xxhash64(*axes), pieces))
    blocks = dealt.groupBy("id", "lab", "tree", "piece").agg(F.flatten(F.collect_list(F.array(*axes, "w"))).alias("data"))
    blocks = blocks.drop("piece").withColumn("q", F.monotonically_increasing_id())
    return roots, materialise(families, "tree-families"), materialise(blocks, "tree-blocks")


def _nodes(placed: DataFrame, axes: list[str], low: dict[str, float], side: float, level: int) -> DataFrame:
    """One row for each cube of a level, with its moments around the middle of the cube taken to its mean."""
    d, width = len(axes), side / 2.0**level
    middle = {a: F.lit(low[a]) + (F.col(f"p_{a}") + 0.5) * width for a in axes}
    off = {a: F.col(a) - middle[a] for a in axes}
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    found = placed.groupBy("lab", "tree", "id", *[f"p_{a}" for a in axes]).agg(
        F.count("*").alias("points"),
        F.sum("w").alias("weight"),
        *[F.sum(F.col("w") * off[a]).alias(f"s_{a}") for a in axes],
        *[F.sum(F.col("w") * off[axes[i]] * off[axes[j]]).alias(f"s_{i}_{j}") for i, j in pairs],
        *[F.min(a).alias(f"low_{a}") for a in axes],
        *[F.max(a).alias(f"high_{a}") for a in axes],
    )
    found = found.withColumns({f"m_{a}": F.col(f"s_{a}") / F.col("weight") for a in axes})
    found = found.withColumns({f"c_{a}": middle[a] + F.col(f"m_{a}") for a in axes})
    moments = {(i, j): F.col(f"s_{i}_{j}") / F.col("weight") - F.col(f"m_{axes[i]}") * F.col(f"m_{axes[j]}") for i, j in pairs}
    reach = [F.greatest(F.col(f"c_{a}") - F.col(f"low_{a}"), F.col(f"high_{a}") - F.col(f"c_{a}")) for a in axes]
    radius = F.sqrt(reduce(lambda a, b: a + b, [r * r for r in reach]))
    data = F.array("weight", *[f"c_{a}" for a in axes], radius, *[moments[p] for p in pairs])
    is_leaf = F.lit(True) if level == LEVELS else F.col("points") <= LEAF
    # A shift of the places halves them, which is the cube of the level above.
    parent = _id(level - 1, [F.shiftright(f"p_{a}", 1) for a in axes]) if level else F.lit(None).cast("string")
    return found.select("lab", "tree", "id", parent.alias("parent"), "points", "weight", is_leaf.alias("is_leaf"), data.alias("data"))


def mean_distances(roots: DataFrame, families: DataFrame, blocks: DataFrame, d: int, factor: float) -> DataFrame:
    """``q, tree, mine, size, data``: limits of the mean distance from each point of a block to the clusters it needs.

    ``data`` holds the lower limits and then the upper ones, at most ``factor`` apart. A block has its own cluster
    (``mine``) and each that may be the nearest other one for any of its points.
    """
    spark = blocks.sparkSession
    cores = spark.sparkContext.defaultParallelism
    queries = blocks.select("q", "lab", F.col("tree").alias("own"), "data")
    # Every block meets every root of its labelling once; roots are copied for each share of the blocks.
    shares = max(1, min(cores, blocks.count() // 64))
    own = queries.drop("data").withColumn("share", F.pmod(F.xxhash64("q"), F.lit(shares)).cast("int"))
    copies = roots.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    first = own.join(copies, ["lab", "share"]).withColumn("mine", F.col("tree") == F.col("own"))
    first = materialise(first.select("q", "tree", "id", "leaf", "size", "mine"), "tree-first")
    nothing, infinite = F.array().cast("array<double>"), F.lit(float("inf"))
    live = first.select("q", "tree", nothing.alias("data"), "size", "mine", infinite.alias("best"))
    pairs = first.select("q", "tree", "id", "leaf")
    finals = []
    while True:
        none = {n: F.lit(None).cast(t) for n, t in (field.split(" ") for field in MEETING.split(", "))}

        def rows(df: DataFrame, kind: int) -> DataFrame:
            return df.select(*[(F.lit(kind) if n == "kind" else F.col(n) if n in df.columns else c).alias(n) for n, c in none.items()])

        met = rows(queries.join(live.select("q").distinct(), "q", "left_semi").select("q", "data"), BLOCK)
        met = met.union(rows(live, STATE))
        met = met.union(rows(pairs.filter("NOT leaf").select("q", "tree", "id").join(families, "id"), NODES))
        met = met.union(rows(pairs.filter("leaf").select("q", "tree", "id").join(blocks.select("id", "data"), "id"), POINTS))
        parts = max(cores, pairs.count() // ROWS)
        met = met.repartition(parts, "q").sortWithinPartitions("q", F.coalesce("tree", F.lit("")), "kind")
        met = materialise(met.mapInPandas(_meeting(d, factor), MET), "tree-met")
        states = met.filter("state").drop("id", "leaf")
        others = F.min(F.when(~F.col("mine"), F.col("most"))).over(W.partitionBy("q"))  # a block's clusters
        states = states.withColumn("best", F.least("best", others)).filter("mine OR least <= best")
        states = materialise(states, "tree-states")
        finals.append(states.filter("done").select("q", "tree", "mine", "size", "data"))
        live = states.filter("NOT done").select("q", "tree", "data", "size", "mine", "best")
        if live.isEmpty():
            break
        pairs = materialise(met.filter("NOT state").select("q", "tree", "id", "leaf").join(live.select("q", "tree"), ["q", "tree"]), "tree-open")
    return reduce(DataFrame.unionByName, finals)


def limits(x: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper limits of the mean distance from each point to each node: weight, mean, radius, covariance."""
    d = x.shape[1]
    radius, moments = nodes[:, d + 1], np.maximum(nodes[:, d + 2 :], -np.inf)
    off = [x[:, i, None] - nodes[None, :, 1 + i] for i in range(d)]
    squared = np.zeros_like(off[0])
    for o in off:
        squared += o * o
    near = np.sqrt(squared)
    along, spread, at = np.zeros_like(near), np.zeros(len(nodes)), 0
    for i in range(d):
        for j in range(i, d):
            along += (1 if i == j else 2) * moments[:, at] * off[i] * off[j]
            if i == j:
                spread += np.maximum(moments[:, at], 0.0)
            at += 1
    far = np.sqrt(squared + spread)
    gap = near - radius
    outside = gap > 0
    safe, room = np.where(outside, near, 1.0), np.where(outside, gap, 1.0)
    middle = near + (spread - along / (safe * safe)) / (2 * safe)
    error = REMAINDER * radius * spread / (room * room)
    low = np.where(outside, np.maximum(near, middle - error), near)
    high = np.where(outside, np.minimum(far, middle + error), far)
    # Rounding may turn limits that agree.
    return np.minimum(low, high), np.maximum(low, high)


def _meeting(d: int, factor: float):
    width = d + 2 + d * (d + 1) // 2

    class Cluster:
        """What a block knows of one cluster: settled and open sums, and limits of the mean from earlier rounds."""

        def __init__(self, points: int, row) -> None:
            self.size, self.mine, self.best = row.size, row.mine, row.best
            known = np.asarray(row.data, dtype=float)
            self.settled = known[: 2 * points].reshape(2, points).copy() if len(known) else np.zeros((2, points))
            self.low = known[2 * points : 3 * points] if len(known) else np.zeros(points)
            self.high = known[3 * points :] if len(known) else np.full(points, np.inf)
            self.left = np.zeros((2, points))
            self.open: list[tuple[str, bool]] = []

        def nodes(self, x: np.ndarray, ids: np.ndarray, leaf: np.ndarray, data: np.ndarray) -> None:
            step = max(1, HELD // len(x))
            allowed = (factor - 1) * self.low[:, None]
            for i in range(0, len(data), step):
                part = data[i : i + step]
                low, high = limits(x, part)
                done = (high - low <= allowed).all(axis=0)
                weight = part[:, 0]
                self.settled += np.stack([low[:, done] @ weight[done], high[:, done] @ weight[done]])
                self.left += np.stack([low[:, ~done] @ weight[~done], high[:, ~done] @ weight[~done]])
                at = i + np.flatnonzero(~done)
                self.open.extend(zip(ids[at], leaf[at]))

        def points(self, x: np.ndarray, data: np.ndarray) -> None:
            step = max(1, HELD // len(x))
            for i in range(0, len(data), step):
                part = data[i : i + step]
                squared = np.zeros((len(x), len(part)))
                for j in range(d):
                    off = x[:, j, None] - part[None, :, j]
                    squared += off * off
                self.settled += np.sqrt(squared) @ part[:, d]

        def out(self, q: int, tree: str) -> list[tuple]:
            low, high = (self.settled + self.left) / self.size
            low = np.maximum(low, self.low)
            high = np.maximum(np.minimum(high, self.high), low)
            done = not self.open or bool((high <= factor * low).all())
            data = [low, high] if done else [*self.settled, low, high]
            rows = [(q, tree, True, None, None, np.concatenate(data), self.size, self.mine, self.best, done, low.min(), high.max())]
            if not done:
                rows += [(q, tree, False, i, bool(leaf), None, None, None, None, None, None, None) for i, leaf in self.open]
            return rows

    names = [field.split(" ")[0] for field in MET.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, x, tree, cluster = None, np.zeros((0, d)), None, None
        found: list[tuple] = []
        for batch in batches:
            block = batch["q"].to_numpy()
            trees, kinds = batch["tree"].fillna("").to_numpy(), batch["kind"].to_numpy()
            change = np.flatnonzero((block[1:] != block[:-1]) | (trees[1:] != trees[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for start, stop in zip([0, *change], [*change, len(batch)]):
                if (block[start], trees[start]) != (q, tree) and cluster is not None:
                    found += cluster.out(int(q), tree)
                    cluster = None
                q, tree, kind = block[start], trees[start], kinds[start]
                part = batch.iloc[start:stop]
                if kind == BLOCK:
                    x = np.asarray(part["data"].iloc[0]).reshape(-1, d + 1)[:, :d]
                elif kind == STATE:
                    cluster = Cluster(len(x), next(part.itertuples(index=False)))
                elif kind == NODES:
                    data = np.concatenate(part["data"].to_list()).reshape(-1, width)
                    cluster.nodes(x, np.concatenate(part["ids"].to_list()), np.concatenate(part["leaf"].to_list()), data)
                else:
                    cluster.points(x, np.concatenate(part["data"].to_list()).reshape(-1, d + 1))
            if len(found) >= 10_000:
                yield pd.DataFrame(found, columns=names)
                found = []
        if cluster is not None:
            found += cluster.out(int(q), tree)
        if found:
            yield pd.DataFrame(found, columns=names)

    return run
