"""Sums of distances from points to weighted points, far ones by interpolation with a proven error.

Either side stands in a tree of boxes. Boxes that meet point by point take as many distances as they have pairs.
Where they are far apart for their size, the distance is smooth in every coordinate of either side, so a grid of Chebyshev nodes, on an axis with
few distinct values those values themselves, stands in for the points of a box that has fewer nodes than points. Sources hand their
weights to their nodes before the meeting, and nodes hand their sums to their box's points at the end. Larger boxes meet as a whole
where nodes or points number ``most`` at the most on each side, or nodes save most of the pairs; other ones are opened.

Nodes are taken only where the error is known to stay within ``ERROR`` of every single distance. Along one axis the distance is
``sqrt(u * u + rest)``, analytic but for ``u = +-i sqrt(rest)``. With an ellipse of parameter r around the axis that
leaves those points outside, and no value above m inside, p nodes are off by 4 m / (r - 1) r^(1 - p) at most (Bernstein). An error passes
the other axes' nodes with a factor of ``LEBESGUE`` for each at most.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np

#: Largest error of a distance, as a share of it.
ERROR = 1e-10
#: Numbers of nodes that an axis may have, and the most by which the largest raises an error: 1 + 2 / pi ln(nodes).
NODES = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15])
LEBESGUE = 2.73
#: Most points whose nodes are found at a time, and products held for that.
PART = 4096
SHARES = 1 << 21
#: Distances held at a time where squares are expanded.
TILE = 1 << 16
#: Most sums held at nodes before they are handed on.
HELD = 1 << 24
#: Pairs of points for each pair of nodes from which boxes of any size meet as a whole.
WORTH = 16
#: Squared extent over squared distance up to which squares may be expanded: the rounding of a distance stays under 1e-13.
EXPANDED = 100.0


def tree(x: np.ndarray, most: int) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """An order of the points, and boxes (start, stop, and the numbers of both halves or 0) in that order: the widest axis
    is cut so that leaves have even numbers of points, ``most`` at the most. Box 0 has all points."""
    order = np.arange(len(x))
    boxes: list[tuple[int, int, int, int]] = [(0, len(x), 0, 0)]
    at = 0
    while at < len(boxes):
        start, stop, *_ = boxes[at]
        leaves = -(-(stop - start) // most)
        if leaves > 1:
            own = order[start:stop]
            part = x[own]
            middle = (stop - start) * (leaves // 2) // leaves
            axis = int((part.max(axis=0) - part.min(axis=0)).argmax())
            order[start:stop] = own[np.argpartition(part[:, axis], middle)]
            boxes[at] = start, stop, len(boxes), len(boxes) + 1
            boxes += [(start, start + middle, 0, 0), (start + middle, stop, 0, 0)]
        at += 1
    return order, boxes


class Boxes:
    """The tree of some points: boxes, and the nodes that may stand in for their points."""

    def __init__(self, x: np.ndarray, most: int) -> None:
        self.order, self.boxes = tree(x, most)
        self.x = x[self.order]
        parts = [self.x[start:stop] for start, stop, *_ in self.boxes]
        low, high = np.array([p.min(axis=0) for p in parts]), np.array([p.max(axis=0) for p in parts])
        self.middle, self.half = (low + high) / 2, (high - low) / 2
        self.values: list[list[np.ndarray | None]] = []
        for start, stop, *_ in self.boxes:
            self.values.append([v if len(v := np.unique(axis)) <= NODES[-1] and np.isfinite(v).all() else None for axis in self.x[start:stop].T])
        self.kinds = np.array([[NODES[-1] + 1 if v is None else len(v) for v in box] for box in self.values])
        self.points = np.array([stop - start for start, stop, *_ in self.boxes])
        self.children = np.array([box[2:] for box in self.boxes])
        self.known: dict[tuple, np.ndarray] = {}

    def _axis(self, box: int, j: int, count: int) -> np.ndarray:
        values = self.values[box][j]
        if values is not None and len(values) <= count:
            return values
        return self.middle[box, j] + self.half[box, j] * np.cos((2 * np.arange(count) + 1) * np.pi / (2 * count))

    def nodes(self, box: int, counts: tuple[int, ...]) -> np.ndarray:
        """The grid with so many nodes on each axis."""
        if (box, counts) not in self.known:
            each = [self._axis(box, j, count) for j, count in enumerate(counts)]
            self.known[box, counts] = np.stack(np.meshgrid(*each, indexing="ij"), axis=-1).reshape(-1, len(counts))
        return self.known[box, counts]

    def shares(self, box: int, counts: tuple[int, ...], x: np.ndarray) -> list[np.ndarray]:
        """For each axis every point's shares of the nodes: the values at x of the polynomials that are 1 at one node and 0 at the others."""
        found = []
        for j, count in enumerate(counts):
            at = self._axis(box, j, count)
            off = x[:, j, None] - at
            hit = off == 0
            if self.values[box][j] is not None and len(at) == len(self.values[box][j]):
                found.append(hit.astype(float))
                continue
            part = np.sin((2 * np.arange(count) + 1) * np.pi / (2 * count)) * (-1.0) ** np.arange(count) / np.where(hit, 1.0, off)
            on = hit.any(axis=1)
            part[on] = hit[on]
            found.append(part / part.sum(axis=1)[:, None])
        return found

    def gathered(self, box: int, counts: tuple[int, ...], weights: np.ndarray) -> np.ndarray:
        """Weights of a box's points, handed to its nodes."""
        start, stop, *_ = self.boxes[box]
        total, step = 0.0, _step(weights)
        for low in range(start, stop, step):
            high = min(stop, low + step)
            *others, last = self.shares(box, counts, self.x[low:high])
            total += _joined(others, high - low).T @ _joined([last, weights[low:high]], high - low)
        return total.reshape(-1, weights.shape[1])

    def spread(self, box: int, counts: tuple[int, ...], given: np.ndarray, sums: np.ndarray) -> None:
        """Sums at a box's nodes, handed to its points."""
        start, stop, *_ = self.boxes[box]
        step = _step(given)
        for low in range(start, stop, step):
            high = min(stop, low + step)
            *others, last = self.shares(box, counts, self.x[low:high])
            part = _joined(others, high - low) @ given.reshape(-1, last.shape[1] * given.shape[1])
            sums[low:high] += np.matmul(last[:, None, :], part.reshape(high - low, last.shape[1], -1))[:, 0]


def _step(columns: np.ndarray) -> int:
    """Points at a time whose shares of an axis's nodes are held for every column."""
    return max(1, min(PART, SHARES // (int(NODES[-1]) * columns.shape[1])))


def _joined(parts: list[np.ndarray], rows: int) -> np.ndarray:
    """For every row all products of one value from each part."""
    return reduce(lambda a, b: (a[:, :, None] * b[:, None, :]).reshape(rows, -1), parts, np.ones((rows, 1)))


def needed(a: Boxes, i: np.ndarray, b: Boxes, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For pairs of boxes: nodes on each axis of either one, infinite where ``NODES`` has no number that will do, the distance of the boxes, and the squared reach of the pair."""
    half, others = a.half[i], b.half[k]
    apart = np.abs(a.middle[i] - b.middle[k])
    gap = np.maximum(apart - half - others, 0.0)
    reach = (apart + half + others) ** 2
    least = np.sqrt((gap * gap).sum(axis=1))[:, None]
    beside = np.sqrt(np.maximum(least * least - gap * gap, 0.0))
    past = reach.sum(axis=1)[:, None] - reach
    kinds = a.kinds[i], b.kinds[k]

    def fitting(raised: np.ndarray | float) -> list[np.ndarray]:
        found = []
        for size, across, distinct in ((half, others, kinds[0]), (others, half, kinds[1])):
            with np.errstate(divide="ignore", invalid="ignore"):
                g, s = gap / size, beside / size
                long = np.where(g > 0, np.hypot(g, s) + np.hypot(2 + g, s), 2 * np.hypot(1.0, s)) / 2
                r = long + np.sqrt(np.maximum(long * long - 1, 0.0))
                top = np.sqrt((apart + across + size * long) ** 2 + past)
                count = 1 + np.log(4 * top * raised / ((r - 1) * ERROR * least)) / np.log(r)
            count = np.where(np.isfinite(count) & (count <= NODES[-1]) & (r > 1), count, np.inf)
            known = np.append(NODES, np.inf)[np.searchsorted(NODES, count)]
            found.append(np.where(distinct <= np.minimum(known, NODES[-1]), distinct, known))
        return found

    # Axes that take their distinct values have no error: a larger number needed leaves them so.
    axes = sum((count != distinct).sum(axis=1) for count, distinct in zip(fitting(1.0), kinds))
    found = fitting(((LEBESGUE ** np.maximum(axes, 1) - 1) / (LEBESGUE - 1))[:, None])
    return found[0], found[1], least[:, 0], reach.sum(axis=1)


class Sums:
    """For every one of the points x the weighted sums of its distances, one for each of ``width`` columns; ``rows`` points meet others one at a time."""

    def __init__(self, x: np.ndarray, width: int, most: int, rows: int = 64) -> None:
        self.own, self.most, self.rows = Boxes(x, most), most, rows
        self.sums = np.zeros((len(x), width))
        self.held: dict[tuple[int, tuple[int, ...]], np.ndarray] = {}
        self.size, self.error = 0, 0.0

    def meet(self, y: np.ndarray, weights: np.ndarray, columns: np.ndarray) -> None:
        """To the sums in ``columns``, add the distances to the points y, weighted in every one of them."""
        own, other = self.own, Boxes(y, self.most)
        weights = weights[other.order]
        pairs = np.zeros((1, 2), dtype=int)
        found = defaultdict(list)
        while len(pairs):
            i, k = pairs.T
            mine, its, least, reach = needed(own, i, other, k)
            by = [(m.prod(axis=1) < points) & np.isfinite(m).all(axis=1) for m, points in ((mine, own.points[i]), (its, other.points[k]))]
            many, others = (np.where(taken, m.prod(axis=1), points) for taken, m, points in ((by[0], mine, own.points[i]), (by[1], its, other.points[k])))
            done = (many <= self.most) & (others <= self.most) | (WORTH * many * others <= own.points[i] * other.points[k])
            clear = reach <= EXPANDED * least * least
            for n in np.flatnonzero(done):
                to, from_ = (tuple(m[n].astype(int)) if taken[n] else None for m, taken in ((mine, by[0]), (its, by[1])))
                found[k[n], from_].append((i[n], to, clear[n]))
            # The side with more to meet is opened; a leaf never has too much.
            first, second = ~done & (many >= others), ~done & (many < others)
            opened = [np.column_stack([own.children[i[first], half], k[first]]) for half in (0, 1)]
            pairs = np.concatenate([*opened, *[np.column_stack([i[second], other.children[k[second], half]]) for half in (0, 1)]])
        for (k, from_), targets in found.items():
            self._meeting(other, k, from_, weights, columns, targets)
            if self.size > HELD:
                self._hand_on()

    def _meeting(self, other: Boxes, k: int, from_: tuple[int, ...] | None, weights: np.ndarray, columns: np.ndarray, targets: list[tuple]) -> None:
        """One box of the others, by its points or nodes, and the boxes that it meets."""
        start, stop, *_ = other.boxes[k]
        points = other.x[start:stop] if from_ is None else other.nodes(k, from_)
        given = weights[start:stop] if from_ is None else other.gathered(k, from_, weights)
        y = points - other.middle[k]
        expanded = np.column_stack([-2 * y, np.ones(len(y)), (y * y).sum(axis=1)]).T
        step = max(1, TILE // len(y))
        tile = np.empty(step * len(y))
        for i, to, clear in targets:
            if to is not None or from_ is not None:
                self.error = ERROR
            if to is None:
                low, high, *_ = self.own.boxes[i]
                at, total = self.own.x[low:high], self.sums[low:high]
            else:
                at = self.own.nodes(i, to)
                if (i, to) not in self.held:
                    self.held[i, to] = np.zeros((len(at), self.sums.shape[1]))
                    self.size += self.held[i, to].size
                total = self.held[i, to]
            if not clear:
                _direct(at, points, given, total, columns, self.rows)
                continue
            at = at - other.middle[k]
            both = np.column_stack([at, (at * at).sum(axis=1), np.ones(len(at))])
            for low in range(0, len(at), step):
                part = both[low : low + step]
                squared = np.matmul(part, expanded, out=tile[: len(part) * len(y)].reshape(len(part), len(y)))
                total[low : low + step, columns] += np.sqrt(squared, out=squared) @ given

    def _hand_on(self) -> None:
        for (i, counts), given in self.held.items():
            self.own.spread(i, counts, given, self.sums)
        self.held, self.size, self.own.known = {}, 0, {}

    def totals(self) -> np.ndarray:
        """In the order of x."""
        self._hand_on()
        found = np.empty_like(self.sums)
        found[self.own.order] = self.sums
        return found


def _direct(x: np.ndarray, y: np.ndarray, weights: np.ndarray, sums: np.ndarray, columns: np.ndarray, rows: int) -> None:
    axes = np.ascontiguousarray(y.T)
    tiles = np.empty((2, rows, len(y)))
    for low in range(0, len(x), rows):
        own = x[low : low + rows]
        squared, difference = tiles[:, : len(own)]
        squared[:] = 0
        for j, axis in enumerate(axes):
            np.subtract(own[:, j, None], axis, out=difference)
            np.multiply(difference, difference, out=difference)
            np.add(squared, difference, out=squared)
        sums[low : low + rows, columns] += np.sqrt(squared, out=squared) @ weights
