"""Merkle manifest of a dataset: a digest for every row, subset and the whole, with proofs.

Every row is a leaf. The leaves of a group, in order, are the lowest level of its tree; at every level the nodes whose
slot in their run is zero compute the indices of their siblings (XOR for runs of two, slot offsets otherwise),
meet them in an equijoin of the level with itself, and emit the run's parent. What remains of each
group is its subroot; the subroots, ordered by group, make a tree of their own, whose last node is the root.
Proofs go down again, level by level: a run joins the run that its parent stands in.

Places in a group come from a range partitioning by group and order, so a group with most of the rows is ranked by
many tasks, and a join never sees more rows of one key than a run is long. A level is a table of its own in
the shared folder.

Defined results: a null field is ``-`` in the leaf, a null group is a group of its own and comes first, a null key
comes first in its group; rows that agree in group and key are ordered by their leaves, and repeated rows are as many
equal leaves; other columns are ignored; a text of any length is hashed whole, where it is read; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.llm.bounded import small
from cartwise.session import materialise

FANOUT = 16
PATH = "array<struct<slot: int, run: array<string>>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields: UTF-8 byte count, ``:`` and value of each, or ``-``."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``place``, counted from 0 within each run of equal ``g``."""
    last, count = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        codes = batch.column("g").dictionary_encode()
        own = codes.indices.to_numpy()
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        place = np.arange(batch.num_rows) - np.repeat(starts, np.diff(np.append(starts, batch.num_rows)))
        values = codes.dictionary.to_pylist()
        if values[own[0]] == last:
            place[: starts[1] if len(starts) > 1 else batch.num_rows] += count
        last, count = values[own[-1]], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "place"])


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, their place within ``g`` by ``order``, and ``m``, how many rows ``g`` has. ``g`` is never null.

    ``rows`` should be written already, and ``order`` tell all rows apart, so that no place depends on the partitioning.
    """
    dealt = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    dealt = dealt.select(*rows.columns, F.spark_partition_id().alias("part"))
    schema = ", ".join(f"`{n}` {t}" for n, t in dealt.dtypes)
    placed = materialise(dealt.mapInArrow(_numbered, f"{schema}, place long"), "placed")
    parts = placed.groupBy("g", "part").agg(F.count("*").alias("held"))
    whole = W.partitionBy("g")  # as many rows as there are partitions
    before = F.sum("held").over(whole.orderBy("part")) - F.col("held")
    offsets = materialise(parts.select("g", "part", before.alias("before"), F.sum("held").over(whole).alias("m")), "offsets")
    found = placed.join(small(offsets), ["g", "part"])
    return found.select(*rows.columns, (F.col("before") + F.col("place")).alias("i"), "m")


def _siblings(index: Column, fanout: int) -> Column:
    """The indices beside ``index`` in its run."""
    if fanout == 2:
        return F.array(index.bitwiseXOR(F.lit(1).cast("long")))
    slot = index % fanout
    return F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)), lambda k: index - slot + (slot + k) % fanout)


def _runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """``g, p, m, run``: the digests of each run, under the index of its parent; ``m`` counts the parents of ``g``."""
    parent, parents = F.floor(F.col("i") / fanout), F.ceil(F.col("m") / fanout)
    zero = nodes.filter(F.col("i") % fanout == 0).select("g", "i", "h", parent.alias("p"), parents.alias("parents"))
    asked = zero.select("g", "p", "parents", F.explode(_siblings(F.col("i"), fanout)).alias("i"))
    met = asked.join(nodes.select("g", "i", "h"), ["g", "i"]).select("g", "p", "parents", "i", "h")
    run = F.array_sort(F.collect_list(F.struct("i", "h")))  # as many as a run is long
    both = met.union(zero.select("g", "p", "parents", "i", "h")).groupBy("g", "p").agg(F.max("parents").alias("m"), run.alias("run"))
    return both.select("g", "p", "m", F.transform("run", lambda x: x.h).alias("run"))


def grow(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, lowest first, and ``g, h``: what remains of each group. ``nodes`` are ``g, i, m, h``."""
    levels = []
    tops = [nodes.filter("m = 1").select("g", "h")]
    most = nodes.agg(F.max("m")).first()[0] or 0
    while most > 1:
        runs = materialise(_runs(nodes.filter("m > 1"), fanout), "runs")
        nodes = runs.select("g", F.col("p").alias("i"), "m", digest(F.array_join("run", "")).alias("h"))
        tops.append(nodes.filter("m = 1").select("g", "h"))
        levels.append(runs)
        most = -(-most // fanout)
    found = tops[0]
    for more in tops[1:]:
        found = found.union(more)
    return levels, found


def _climb(index: Column, fanout: int) -> Column:
    step = F.struct((index % fanout).cast("int").alias("slot"), F.col("run").alias("run"))
    return F.concat(F.array(step), F.col("above")).cast(PATH)


def paths(levels: list[DataFrame], outer: DataFrame, fanout: int = FANOUT) -> DataFrame | None:
    """``g, p, run, above``: the lowest runs with the path from their parent to the root; ``outer`` is ``g, above``, the path of each
    group's last node."""
    found = None
    for runs in reversed(levels):
        top = runs.filter("m = 1").join(outer, "g").select("g", "p", "run", "above")
        if found is not None:
            over = found.select("g", F.col("p").alias("q"), "run", "above")
            below = runs.filter("m > 1").select("g", "p", F.floor(F.col("p") / fanout).alias("q"), F.col("run").alias("own"))
            met = below.join(over, ["g", "q"]).select("g", "p", F.col("own").alias("run"), _climb(F.col("p"), fanout).alias("above"))
            top = top.union(met)
        found = materialise(top, "paths")
    return found


def _attached(nodes: DataFrame, levels: list[DataFrame], outer: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with ``path``: slot and run at each level, up to the root."""
    alone = nodes.filter("m = 1").join(outer, "g").select(*nodes.columns, F.col("above").cast(PATH).alias("path"))
    lowest = paths(levels, outer, fanout)
    if lowest is None:
        return alone
    below = nodes.filter("m > 1").withColumn("p", F.floor(F.col("i") / fanout))
    return below.join(lowest, ["g", "p"]).select(*nodes.columns, _climb(F.col("i"), fanout).alias("path")).union(alone)


def manifest(documents: DataFrame, key: str, group: str, fields: list[str], fanout: int = FANOUT, others: dict[str, Column] | None = None) -> DataFrame:
    """``<key>, leaf, subroot, root, path`` for every row, and the columns ``others``, computed from the row.

    ``path`` holds, level by level, the row's slot in its run and the digests of the run.
    """
    own = {"h": leaf([F.col(f"`{f}`") for f in fields]), **(others or {})}
    # Bytewise, null first.
    name = F.when(F.col(f"`{group}`").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")))
    rows = documents.select(name.alias("g"), F.col(f"`{key}`").alias("key"), *[c.alias(n) for n, c in own.items()], F.monotonically_increasing_id().alias("row"))
    nodes = materialise(ranked(materialise(rows, "leaves"), ["key", "h", "row"]), "nodes")
    levels, tops = grow(nodes.select("g", "i", "m", "h"), fanout)
    groups = materialise(tops, "subroots").select(F.lit("").alias("g"), F.col("g").alias("name"), "h")
    groups = materialise(ranked(groups, ["name"]), "groups")
    higher, last = grow(groups.select("g", "i", "m", "h"), fanout)
    start = last.select("g", F.array().cast(PATH).alias("above"))
    reach = _attached(groups, higher, start, fanout).join(last.select("g", F.col("h").alias("root")), "g")
    reach = materialise(reach.select(F.col("name").alias("g"), F.col("path").alias("above"), F.col("h").alias("subroot"), "root"), "reach")
    found = _attached(nodes, levels, reach.select("g", "above"), fanout).join(small(reach.select("g", "subroot", "root")), "g")
    return found.select(F.col("key").alias(key), F.col("h").alias("leaf"), "subroot", "root", "path", *(others or {}))


def proof(path: Column) -> Column:
    """Digest of the siblings on the way up, left to right at each level."""
    besides = F.transform(path, lambda s: F.array_join(F.concat(F.slice(s.run, F.lit(1), s.slot), F.slice(s.run, s.slot + 2, F.size(s.run))), ""))
    return digest(F.array_join(besides, ""))


def folded(node: Column, path: Column) -> Column:
    """The root that follows from ``node`` and its siblings."""

    def parent(below: Column, s: Column) -> Column:
        left, right = F.slice(s.run, F.lit(1), s.slot), F.slice(s.run, s.slot + 2, F.size(s.run))
        return digest(F.array_join(F.concat(left, F.array(below), right), ""))

    return F.aggregate(path, node, parent)
