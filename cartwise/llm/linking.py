"""Links inside groups of nodes, found in blocks within tasks: no pair is a row, and no group is one task's.

Nodes that share a key may be linked. :func:`leader_groups` puts the nodes of a key into the group of the key's smallest
node, so that keys with much the same nodes, as the shingles of near copies are, become one group. Any two nodes of
a key are in one group. :func:`block_links` brings what is known of each node to its groups and compares there:

* a group that fits a block is compared whole;
* the nodes of a larger one meet its smallest node first; those linked to it are in one component and need no check among
  themselves. The others are dealt into blocks by hash, and every block meets every block, but for two blocks of linked nodes.

So every pair of a group is compared, or known to be in one component. A block returns its components as stars of
one node with the others, never its pairs. Blocks are bounded by nodes and by what they weigh; one heavy node can make a block by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.bounded import small
from cartwise.session import materialise

#: Linked places ``i, j`` of a block, from what is known of its nodes. ``side`` is all 0, or only places of different sides need to be
#: compared. Small blocks come many at a time, in runs of equal ``block``; places of two blocks are never linked.
Compare = Callable[[list[pa.Array], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
BLOCK_NODES = 512
BLOCK_WEIGHT = 2_000_000
#: Columns of an incidence block that are multiplied at a time.
COLUMNS = 1 << 13
#: Nodes of a small block, and list values, or bytes of text, of small blocks that are compared together.
SMALL, TOGETHER = 24, 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


def leader_groups(incidence: DataFrame) -> DataFrame:
    """``group, node`` from ``key, node``: the nodes of keys that have several, under the smallest node of the key."""
    own = incidence.groupBy("key").agg(F.min("node").alias("group"), F.max("node").alias("last"))
    return incidence.join(own.filter("group < last").select("key", "group"), "key").select("group", "node").distinct()


def local_roots(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each place by the links ``i, j``."""
    roots = np.arange(count)
    while True:
        least = roots.copy()
        np.minimum.at(least, i, roots[j])
        np.minimum.at(least, j, roots[i])
        least = least[least]
        if (least == roots).all():
            return roots
        roots = least


def overlaps(columns: np.ndarray, sizes: np.ndarray, side: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield a place, the places it is compared with, and how many columns each shares with it.

    ``columns`` are the sets of all places, one behind the other, none with a column twice. The product of the block's
    incidence matrix with its transpose is added up over runs of columns, as bits, and over columns that several sets have.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(columns, kind="stable")
    fresh = np.empty(len(columns), dtype=bool)
    fresh[:1] = True
    fresh[1:] = columns[order][1:] != columns[order][:-1]
    code = np.cumsum(fresh) - 1
    shared = np.bincount(code)[code] > 1
    owner, code = owner[order][shared], code[shared]
    code = np.cumsum(np.append(False, code[1:] != code[:-1])) if len(code) else code
    first = np.flatnonzero(side == 0)
    rest = np.flatnonzero(side) if side.any() else None
    total = np.zeros((len(first), len(sizes)), dtype=np.int32)
    width = COLUMNS if len(code) and code[-1] >= COLUMNS else -(-(int(code[-1]) + 1 if len(code) else 1) // 64) * 64
    edges = np.searchsorted(code, np.arange(0, (int(code[-1]) if len(code) else -1) + 1 + width, width))
    for low, start, stop in zip(range(0, len(edges) * width, width), edges, edges[1:]):
        cells = np.zeros((len(sizes), width), dtype=bool)
        cells[owner[start:stop], code[start:stop] - low] = True
        bits = np.packbits(cells, axis=1).view(np.uint64)
        for n, x in enumerate(first):
            other = slice(x + 1, None) if rest is None else rest
            total[n, other] += np.bitwise_count(bits[x] & bits[other]).sum(axis=1, dtype=np.int32)
    for n, x in enumerate(first):
        other = np.arange(x + 1, len(sizes)) if rest is None else rest
        yield x, other, total[n, other]


def _overlaps_by_block(columns: np.ndarray, sizes: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places ``i < j`` of one block, and how many columns they share, where they share any; every block is small."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    spread = columns.view(np.uint64) + block[owner].astype(np.uint64) * _ODD
    order = np.argsort(spread)
    own, owner = spread[order], owner[order]
    at, far, pairs = np.flatnonzero(own[1:] == own[:-1]), 1, [np.zeros(0, dtype=np.int64)]
    while len(at):
        one, two = owner[at], owner[at + far]
        pairs.append(np.minimum(one, two) * len(sizes) + np.maximum(one, two))
        far += 1
        at = at[at + far < len(own)]
        at = at[own[at + far] == own[at]]
    pairs, common = np.unique(np.concatenate(pairs), return_counts=True)
    i, j = np.divmod(pairs, max(len(sizes), 1))
    same = block[i] == block[j]
    return i[same], j[same], common[same]


def similar_sets(columns: np.ndarray, sizes: np.ndarray, side: np.ndarray, block: np.ndarray, percent: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of sets whose intersection is at least ``percent`` of their union."""
    if len(block) and block[0] != block[-1]:
        i, j, common = _overlaps_by_block(columns, sizes, block)
        hit = common * (100 + percent) >= percent * (sizes[i] + sizes[j]) - 1e-9
        return i[hit], j[hit]
    left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for x, other, common in overlaps(columns, sizes, side):
        hit = other[common * (100 + percent) >= percent * (sizes[x] + sizes[other]) - 1e-9]
        left.append(np.full(len(hit), x))
        right.append(hit)
    return np.concatenate(left), np.concatenate(right)


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray]]:
    """The rows of a block, whole, as slices of sorted batches, with the number of the block; several small ones of one side together."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = np.stack([batch.column(k).to_numpy() for k in keys])
        edges = np.flatnonzero((own[:, 1:] != own[:, :-1]).any(axis=0)) + 1
        if last is not None and (own[:, 0] != last).any():
            edges = np.append(0, edges)
        stop = int(edges[-1]) if len(edges) else 0
        last = own[:, -1]
        if not len(edges):
            held.append(batch)
            continue
        # What ends here, then what is whole within the batch.
        yield [*held, batch.slice(0, int(edges[0]))], np.zeros(sum(b.num_rows for b in held) + int(edges[0]), dtype=np.int64)
        held = [batch.slice(stop)]
        sizes = np.diff(edges)
        small_ones = (sizes <= SMALL) & (own[2, edges[:-1]] == 0)
        for n, (start, size) in enumerate(zip(edges[:-1].tolist(), sizes.tolist())):
            if not small_ones[n]:
                yield [batch.slice(start, size)], np.zeros(size, dtype=np.int64)
        chosen = np.flatnonzero(small_ones & (sizes > 1))
        kind = batch.column("own").type
        width = kind.value_type.bit_width // 8 if pa.types.is_list(kind) else 1
        size = max(batch.column("own").nbytes // batch.num_rows // width, 1)
        run = np.cumsum(sizes[chosen]) * size // TOGETHER
        for some in np.split(chosen, np.flatnonzero(run[1:] != run[:-1]) + 1):
            if len(some):
                rows = np.concatenate([np.arange(edges[n], edges[n + 1]) for n in some])
                yield [batch.take(pa.array(rows))], np.repeat(np.arange(len(some)), sizes[some])
    if held:
        yield held, np.zeros(sum(b.num_rows for b in held), dtype=np.int64)


def _compared(dealt: DataFrame, items: DataFrame, compare: Compare) -> DataFrame:
    """``group, a, b``: the components of every block of ``dealt`` (``group, i, j, side, node``), each node ``b`` with one of its own."""
    keys = ["group", "i", "j"]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for rows, block in _blocks(batches, keys):
            if len(block) < 2:
                continue
            group, side, nodes = (np.concatenate([b.column(c).to_numpy() for b in rows]) for c in ("group", "side", "node"))
            i, j = compare([b.column("own") for b in rows], side, block)
            if not len(i):
                continue
            roots = local_roots(len(nodes), i, j)
            others = np.flatnonzero(roots != np.arange(len(nodes)))
            found.append((group[others], nodes[roots[others]], nodes[others]))
            held += len(others)
            if held > 10_000:
                yield _batch(found)
                found, held = [], 0
        if found:
            yield _batch(found)

    met = dealt.join(items.select("node", "own"), "node").select(*keys, "side", "node", "own")
    return met.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(linked, "group long, a long, b long")


def _batch(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["group", "a", "b"])


def block_links(groups: DataFrame, items: DataFrame, compare: Compare, nodes: int | None = None, weight: int | None = None) -> DataFrame:
    """Links ``a, b`` that make the same components as all links inside the groups do.

    ``groups`` has ``group, node`` (64-bit, no row twice) and ``items`` ``node, weight, own``, a node once; both should be written already.
    """

    nodes, weight = nodes or BLOCK_NODES, weight or BLOCK_WEIGHT

    def parts(n: str, w: str):
        return F.ceil(F.greatest(F.col(n) / nodes, F.col(w) / weight)).cast("int")

    sized = groups.join(items.select("node", "weight"), "node")
    counts = sized.groupBy("group").agg(F.count("*").alias("n"), F.sum("weight").alias("w"), F.min("node").alias("leader")).filter("n > 1")
    counts = materialise(counts.select("group", "leader", parts("n", "w").alias("parts")), "sizes")
    zero = F.lit(0)
    whole = groups.join(counts.filter("parts = 1"), "group").select("group", zero.alias("i"), zero.alias("j"), zero.alias("side"), "node")
    large = counts.filter("parts > 1")
    if large.isEmpty():
        return _compared(small(materialise(whole, "dealt")), items, compare).select("a", "b")
    # With the leader, which goes to every part.
    rows = groups.join(small(materialise(large, "large")), "group")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    led = F.when(F.col("node") == F.col("leader"), F.sequence(zero, F.col("parts") - 1)).otherwise(F.array(part))
    stars = rows.select("group", F.explode(led).alias("i"), F.lit(-1).alias("j"), (F.col("node") != F.col("leader")).cast("int").alias("side"), "node")
    links = materialise(_compared(small(materialise(whole.union(stars), "dealt")), items, compare), "links")
    reached = rows.select("group", "node", "leader").join(links.select("group", F.col("b").alias("node"), F.col("a").alias("leader")), ["group", "node", "leader"], "left_semi")
    # The leader comes first in its blocks, so their components are named after it.
    inside = reached.select("group", "node", F.lit(True).alias("in")).union(rows.filter("node = leader").select("group", "node", F.lit(True))).distinct()
    marked = rows.select("group", "node").join(inside, ["group", "node"], "left").select("group", "node", F.coalesce("in", F.lit(False)).alias("in"))
    marked = materialise(marked.join(items.select("node", "weight"), "node"), "marked")
    sums = {f"{k}{name}": F.coalesce(F.sum(F.when(chosen, v)), zero) for name, chosen in (("in", F.col("in")), ("out", ~F.col("in"))) for k, v in (("n", F.lit(1)), ("w", F.col("weight")))}
    shares = marked.groupBy("group").agg(*[c.alias(n) for n, c in sums.items()]).filter("nout > 0")
    shares = materialise(shares.select("group", parts("nin", "win").alias("ins"), parts("nout", "wout").alias("outs")), "shares")
    spread = marked.join(small(shares), "group")
    hashed = F.xxhash64("node", F.lit(1))
    block = F.when(F.col("in"), F.col("outs") + F.pmod(hashed, F.col("ins"))).otherwise(F.pmod(hashed, F.col("outs"))).cast("int")
    met = F.when(F.col("in"), F.sequence(zero, F.col("outs") - 1)).otherwise(F.sequence(zero, F.col("outs") + F.col("ins") - 1))
    spread = spread.select("group", "node", block.alias("block"), F.explode(met).alias("other"))
    dealt = spread.select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "node")
    return links.select("a", "b").union(_compared(small(materialise(dealt, "dealt")), items, compare).select("a", "b"))
