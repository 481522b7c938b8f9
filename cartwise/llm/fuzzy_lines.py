"""Line dedup over a whole corpus, fuzzy lines included, by MinHash.

A line counts as its lower-cased text without spaces around it; a line of white space alone is never removed. Equal lines
are one entry. Its shingles are all runs of ``Settings.shingle`` characters, named by 64-bit hashes, or the whole line if it is shorter;
``bands`` x ``rows`` minima of hashed shingles give its band keys, and four bits of each minimum its sketch.

Sketches travel with the band keys. A task that holds a key compares the sketches of its lines, links those
that agree in 17 of 30 places, and returns its components as groups; a key with more than ``MANY`` lines is dealt over
several tasks (:mod:`cartwise.llm.linking`). Then the texts of the lines that are left, once for each group, meet in blocks and are verified by
the exact Jaccard similarity of their shingle sets. Links form components by distributed union-find, and of each component only the
first occurrence stays (by document id, then text hash, then place; a null id comes first).

At a similarity of 0.75 the 10 bands of 3 rows find a pair with a probability of 0.996, at 0.8 of 0.999, at 0.9 of more than
0.9999. Two lines that share a band agree in its three minima, and at 0.75 in each further one with 0.766, so fewer than 17 of 30 agree
with a probability of 0.0013. A changed letter breaks as many shingles as one has characters: at 5 a line of 40 characters keeps a
similarity of 31/41 = 0.756. Pairs below the threshold are never linked.

Defined results: a null text stays null and has no lines; an empty text has one empty line; a text whose
lines are all removed is empty, and its row stays; rows that agree in id and text are one document and
keep the same lines; other columns pass through; lines are told apart by two 64-bit hashes, and a line
that shares only the first with another is never removed; an empty table gives an empty table. A line, however long, is whole in one task, which
takes about 30 bytes for each of its characters; a text is whole in its row only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.bounded import is_small, small
from cartwise.llm.components import components
from cartwise.llm.linking import block_links, local_roots, similar_sets
from cartwise.llm.slabs import mixed
from cartwise.session import materialise

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Fills up a line shorter than a shingle; no text holds half a surrogate pair.
_FILL = "\udfff"
#: Share of the sketch in which lines must agree before their texts are compared.
AGREEING = 0.55
#: Lines of a key that one task compares; pairs are looked for side by side among so few, else in blocks.
MANY = 1 << 13
FEW = 64
#: Rows of a key of ``MANY`` lines that are compared with it at a time; of smaller keys more.
ROWS = 4
#: Rows a task takes from its batches at a time.
TOGETHER = 1 << 17
#: Lines a task remembers so as to describe a repeated one once.
SEEN = 1 << 18


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    bands: int = 10
    rows: int = 3
    similarity: float = 0.75


CORPUS = Settings()


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def occurrences(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``k, t, at, line, h, g``: every line that is not all white space, with its document, place and two hashes."""
    own = documents.select(F.col(key).alias("k"), F.xxhash64(text).alias("t"), F.posexplode(_lines(F.lower(text))).alias("at", "raw"))
    own = own.filter(F.ltrim("raw", F.lit(" \t\x0b\f\r")) != "").select("k", "t", "at", F.trim("raw").alias("line"))
    return own.select("k", "t", "at", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def _shingled(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed shingles of joined lines; each line's are those from its start up to its stop. A shorter line is one, filled up."""
    lines = [x.ljust(size, _FILL) for x in lines]
    codes = np.frombuffer("".join([*lines, "\0" * size]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    places = len(codes) - size + 1
    hashed = codes[:places].copy()
    for i in range(1, size):
        hashed *= _STEP
        hashed += codes[i : i + places]
    stops = np.cumsum([len(x) for x in lines])
    return hashed, stops - [len(x) for x in lines], stops - size + 1


def _shingle_sets(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The lines' sets, one behind the other, and their sizes."""
    hashed, starts, stops = _shingled(lines, size)
    counts = stops - starts
    owner = np.repeat(np.arange(len(lines), dtype=np.int32), counts)
    inside = np.append(np.ones(len(hashed) - 1, dtype=bool), False)
    for k in range(size - 1):
        inside[stops + k] = False
    own = hashed[inside]
    del hashed, inside
    stops = np.cumsum(counts)
    for low, high in zip((stops - counts).tolist(), stops.tolist()):
        own[low:high].sort()
    fresh = np.append(True, (own[1:] != own[:-1]) | (owner[1:] != owner[:-1]))
    return own[fresh], np.bincount(owner[fresh], minlength=len(lines))


#: Characters of lines whose signatures are worked out at a time; a longer line is worked on by itself.
SLAB = 1 << 16


def _factors(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def _minima(lines: list[str], factors: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each factor the smallest hashed shingle of every line."""
    hashed, starts, stops = _shingled(lines, size)
    spread = np.append((mixed(hashed) >> np.uint64(32)).astype(np.uint32), np.uint32(0))
    edges = np.stack([starts, stops], axis=1).ravel()
    own = np.empty_like(spread)
    for factor in factors:
        yield np.minimum.reduceat(np.multiply(spread, factor, out=own), edges)[::2]


def _slabs(lines: list[str]) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(lines):
        high, size = low, 0
        while high < len(lines) and (high == low or size + len(lines[high]) <= SLAB):
            size += len(lines[high])
            high += 1
        yield low, high
        low = high


def band_keys(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``key, node, s, t``: the band keys and the sketch of lines ``h, line``."""
    factors = _factors(settings.bands * settings.rows, 11)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes, first = np.unique(batch.column("h").to_numpy(), return_index=True)
            fresh = np.array([x not in seen for x in nodes.tolist()], dtype=bool)
            if len(seen) > SEEN:
                seen = set()
            nodes, first = nodes[fresh], first[fresh]
            seen.update(nodes.tolist())
            lines = _texts(batch.column("line").take(pa.array(first)))
            least = np.empty((len(factors), len(lines)), dtype=np.uint32)
            for low, high in _slabs(lines):
                for number, minimum in enumerate(_minima(lines[low:high], factors, settings.shingle)):
                    least[number, low:high] = minimum
            keys = np.empty((len(lines), settings.bands), dtype=np.uint64)
            sketch = np.zeros((2, len(lines)), dtype=np.uint64)
            for number, minimum in enumerate(least):
                band, row = divmod(number, settings.rows)
                key = np.full(1, band, dtype=np.uint64) if row == 0 else key
                key = mixed(key * _STEP + minimum)
                keys[:, band] = key
                if number < 32:
                    sketch[number % 2] |= (mixed(minimum + _STEP) >> np.uint64(60)) << np.uint64(4 * (number // 2))
            columns = [np.repeat(x.view(np.int64), settings.bands) for x in (nodes, *sketch)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), *map(pa.array, columns)], ["key", "node", "s", "t"])

    return lines.select("h", "line").mapInArrow(keyed, "key long, node long, s long, t long")


_LOW = np.uint64(0x1111111111111111)


def agreeing(s: np.ndarray, t: np.ndarray, s2: np.ndarray, t2: np.ndarray) -> np.ndarray:
    """In how many of 32 places of four bits the sketches agree."""
    apart = []
    for x in (s ^ s2, t ^ t2):
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        x &= _LOW
        apart.append(x)
    apart[1] <<= np.uint64(1)
    return 32 - np.bitwise_count(apart[0] | apart[1]).astype(np.int8)


def _least_agreeing(settings: Settings) -> int:
    """``AGREEING`` of the minima, and the places no minimum fills."""
    held = min(settings.bands * settings.rows, 32)
    return math.ceil(AGREEING * held) + 32 - held


def _close(s: np.ndarray, t: np.ndarray, side: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that make the same components as all pairs of close sketches do; places of one side need no comparison if there are two."""
    count = len(s)
    roots, crossed = np.arange(count), bool(side.any())
    todo, two = (np.flatnonzero(side == 0), np.flatnonzero(side)) if crossed else (np.arange(count),) * 2
    size = 1
    while len(todo):
        # A place outside the first one's component is compared with all; so two inside need no comparison, nor one with all others.
        if crossed:
            todo = todo[roots[todo] != roots[two[0]]] if (roots[two] == roots[two[0]]).all() else todo
        elif size > 1:
            todo = todo[roots[todo] != roots[0]]
        now, todo = todo[:size], todo[size:]
        if not len(now):
            break
        i, j = np.nonzero(agreeing(s[now, None], t[now, None], s[two], t[two]) >= least)
        i, j = now[i], two[j]
        new = roots[i] != roots[j]
        if new.any():
            others = np.flatnonzero(roots != np.arange(count))
            roots = local_roots(count, np.append(roots[others], i[new]), np.append(others, j[new]))
        if not crossed:
            two = two[~np.isin(two, now, assume_unique=True)]  # compared with all that are left
        size = max(ROWS * MANY // max(len(two), 1), 1) if size == 1 else size
    others = np.flatnonzero(roots != np.arange(count))
    return roots[others], others


def _side_by_side(own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Close places within each key; no key has many."""
    key, s, t = own[0], *own[2:].view(np.uint64)
    at, far, left, right = np.flatnonzero(key[1:] == key[:-1]), 1, [], []
    while len(at):
        hit = at[agreeing(s[at], t[at], s[at + far], t[at + far]) >= least]
        left.append(hit)
        right.append(hit + far)
        far += 1
        at = at[at + far < len(key)]
        at = at[key[at + far] == key[at]]
    return np.concatenate(left), np.concatenate(right)


def _grouped(own: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """In whole keys, the components of close lines under their smallest, or the rows of a key with many; ``own`` is sorted by key."""
    if not own.shape[1]:
        return
    sizes = np.diff(np.append(np.flatnonzero(np.append(True, own[0][1:] != own[0][:-1])), own.shape[1]))
    own = own[:, np.repeat(sizes > 1, sizes)]
    own = own[:, np.lexsort(own[1::-1])]
    own = own[:, np.append(True, (own[:2, 1:] != own[:2, :-1]).any(axis=0))[: own.shape[1]]]
    edges = np.append(np.flatnonzero(np.append(True, own[0][1:] != own[0][:-1])[: own.shape[1]]), own.shape[1])
    sizes = np.diff(edges)
    few = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= FEW), sizes))
    links = []
    if len(few):
        links.append(tuple(few[x] for x in _side_by_side(np.ascontiguousarray(own[:, few]), least)))
    for number in np.flatnonzero(sizes > FEW).tolist():
        low, high = edges[number : number + 2]
        if high - low > MANY:
            yield _many(own[:, low:high])
            continue
        s, t = own[2:, low:high].view(np.uint64)
        links.append(tuple(x + low for x in _close(s, t, np.zeros(high - low, dtype=np.int32), least)))
    if links:
        roots = local_roots(own.shape[1], *[np.concatenate(x) for x in zip(*links)])
        some = np.flatnonzero(np.bincount(roots, minlength=len(roots))[roots] > 1)
        yield _likely(own[1][roots[some]], own[1][some], None)


def _many(own: np.ndarray) -> pa.RecordBatch:
    return _likely(None, np.ascontiguousarray(own[1]), own[[0, 2, 3]])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The columns of the batches, as many rows at a time as numpy is worth it."""
    held, size = [], 0
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in ("key", "node", "s", "t")]))
        size += batch.num_rows
        if size >= TOGETHER:
            yield np.concatenate(held, axis=1)
            held, size = [], 0
    if size:
        yield np.concatenate(held, axis=1)


def _likely(group: np.ndarray | None, node: np.ndarray, rest: np.ndarray | None) -> pa.RecordBatch:
    empty = pa.nulls(len(node), pa.int64())
    others = [empty] * 3 if rest is None else [pa.array(np.ascontiguousarray(x)) for x in rest]
    return pa.RecordBatch.from_arrays([empty if group is None else pa.array(group), pa.array(node), *others], ["group", "node", "key", "s", "t"])


def _likely_rows(keyed: DataFrame, least: int) -> DataFrame:
    """``group, node`` of lines in a group together, or ``key, node, s, t`` of those of a key with more than ``MANY``."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, held = np.zeros((4, 0), dtype=np.int64), None
        for rows in _together(batches):
            own = np.concatenate([rest, rows], axis=1)
            if held is not None and own.shape[1]:
                stop = int(np.searchsorted(own[0], held, side="right"))
                yield _many(own[:, :stop])
                own = own[:, stop:]
            if not own.shape[1]:
                rest = own
                continue
            # The last key may go on in the next batch.
            cut, held = int(np.searchsorted(own[0], own[0][-1])), None
            yield from _grouped(own[:, :cut], least)
            rest = own[:, cut:]
            if rest.shape[1] > MANY:
                yield _many(rest)
                held, rest = rest[0][0], rest[:, :0]
        yield from _grouped(rest, least)

    schema = "group long, node long, key long, s long, t long"
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(grouped, schema)


def likely_groups(keyed: DataFrame, settings: Settings) -> DataFrame:
    """``group, node``: any two lines that share a band and have close sketches are in a group together."""
    least = _least_agreeing(settings)
    rows = materialise(_likely_rows(keyed, least), "likely")
    found = rows.filter("key IS NULL").select("group", "node")
    many = rows.filter("key IS NOT NULL")
    if not many.isEmpty():
        sketches = many.select("node", F.lit(1).alias("weight"), F.array("s", "t").alias("own")).dropDuplicates(["node"])
        groups = materialise(many.select(F.col("key").alias("group"), "node").distinct(), "many")

        def close(own: list[pa.Array], side: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            both = np.concatenate([x.flatten().to_numpy() for x in own]).reshape(-1, 2).view(np.uint64)
            edges = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
            found = [_close(*np.ascontiguousarray(both[low:high].T), side[low:high], least) for low, high in zip(edges, edges[1:])]
            return tuple(np.concatenate([x[k] + low for x, low in zip(found, edges)]) for k in (0, 1))

        stars = materialise(block_links(groups, materialise(sketches, "sketches"), close, nodes=MANY), "stars")
        found = found.union(stars.select("a", "b")).union(stars.select("a", "a"))
    return materialise(found.distinct(), "groups")


def removed(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``k, t, at``: the places of lines to remove; ``t`` is the text's ``xxhash64``."""
    every = occurrences(documents, key, text)
    places = materialise(every.drop("line"), "places")
    place = F.struct("k", "t", "at")
    entries = places.groupBy("h").agg(F.min("g").alias("g"), F.max("g").alias("last"), F.count("*").alias("n"), F.min(place).alias("first"))
    groups = likely_groups(band_keys(every, settings), settings)
    wanted = materialise(groups.select(F.col("node").alias("h")).distinct(), "nodes")
    # Repeats of a line are merged before their shuffle.
    texts = every.select("h", "line").join(small(wanted), "h", "left_semi").groupBy("h").agg(F.first("line").alias("line"))
    texts = materialise(texts.select(F.col("h").alias("node"), F.length("line").alias("weight"), F.col("line").alias("own")), "texts")

    def similar(own: list[pa.Array], side: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        columns, sizes = _shingle_sets([x for part in own for x in _texts(part)], settings.shingle)
        return similar_sets(columns, sizes, side, block, 100 * settings.similarity)

    component = components(materialise(block_links(groups, texts, similar), "verified"))
    sound = entries.filter("g = last").join(component, entries.h == component.node, "left")
    sound = materialise(sound.select("h", "n", "first", F.coalesce("component", "h").alias("component")), "lines")
    roots = sound.groupBy("component").agg(F.min("first").alias("kept"), F.sum("n").alias("of")).filter("of > 1")
    repeated = sound.join(roots, "component").select("h", "kept")
    here = places.select("k", "t", "at", "h").join(repeated, "h")
    other = ~(F.col("k").eqNullSafe(F.col("kept.k")) & (F.col("t") == F.col("kept.t")) & (F.col("at") == F.col("kept.at")))
    return here.filter(other).select("k", "t", "at").distinct()


def dedup_lines(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents without removed lines, with ``lines`` and ``lines_removed``, counted before (replaced if they are there)."""
    lost = materialise(removed(documents, key, text, settings), "removed")
    gone = lost.groupBy("k", "t").agg(F.collect_list("at").alias("gone"))
    gone = gone.select(F.col("k").alias("gone k"), F.col("t").alias("gone t"), "gone")
    gone = F.broadcast(gone) if is_small(lost) else gone
    columns = [c for c in documents.columns if c not in ("lines", "lines_removed")]
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(key).alias("k"), F.xxhash64(text).alias("t"))
    both = own.join(gone, F.col("k").eqNullSafe(F.col("gone k")) & (F.col("t") == F.col("gone t")), "left")
    whole = F.col(f"row.`{text}`")
    # A text is cut into lines once, not again for each of them, and only if it loses some.
    both = both.withColumn("cut", F.when(F.col("gone").isNotNull(), _lines(whole)))
    places = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("gone"))
    left = F.array_join(F.transform(places, lambda i: F.get(F.col("cut"), i)), "\n")
    lines = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    out = [F.when(F.col("gone").isNull(), whole).otherwise(left).alias(c) if c == text else F.col(f"row.`{c}`") for c in columns]
    counts = [lines, F.size("gone")]
    return both.select(*out, *[F.greatest(c, F.lit(0)).alias(n) for c, n in zip(counts, ("lines", "lines_removed"))])
