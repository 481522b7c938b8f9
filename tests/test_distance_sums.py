"""Sums of distances by boxes against brute force, and how many distances they take."""

import math

import numpy as np
import pandas as pd
import pytest

from cartwise.operators import distance_sums, silhouette


def summed(x, y, weights, most, cells=3):
    """The sums of every point's distances, the share of all pairs that were met, and the error allowed for."""
    met, found = 0, distance_sums.Sums(x, weights.shape[1], most)
    meeting = found._meeting

    def counted(other, k, from_, given, columns, targets):
        nonlocal met
        many = other.points[k] if from_ is None else math.prod(from_)
        met += sum(many * (found.own.points[i] if to is None else math.prod(to)) for i, to, _ in targets)
        meeting(other, k, from_, given, columns, targets)

    found._meeting = counted
    for part in np.array_split(np.arange(len(y)), cells):
        found.meet(y[part], weights[part], np.arange(weights.shape[1]))
    return found.totals(), met / len(x) / len(y), found.error


def brute_force(x, y, weights):
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1)) @ weights


def test_far_boxes_meet_without_all_pairs():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.exponential(1, 12000), np.round(rng.normal(0, 1, 12000))])
    weights = rng.uniform(0.5, 3, (12000, 2))
    shares = []
    for n in (3000, 12000):
        sums, share, error = summed(x[:n], x[:n], weights[:n], 64)
        shares.append(share)
        some = slice(0, None, 40)
        assert error and np.abs(sums[some] / brute_force(x[:n][some], x[:n], weights[:n]) - 1).max() < 1e-12
    assert shares[0] < 0.6 and shares[1] < 0.5 * shares[0]  # more points, a smaller share of the pairs


@pytest.mark.parametrize("kind", ["outliers", "steps", "constant", "apart", "copies", "line", "axes", "null"])
def test_sums_of_odd_points(kind, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (1500, 3))
    if kind == "outliers":
        x[0], x[1] = 1e7, -1e5
    elif kind == "steps":
        x[:, 0], x[:, 1] = np.round(x[:, 0] * 2), np.round(np.exp(x[:, 1]) * 20) / 20
    elif kind == "constant":
        x[:, 2] = 4.0
    elif kind == "apart":
        x[:, 2] = np.sign(x[:, 2])
        x[700:] += 60
        monkeypatch.setattr(distance_sums, "HELD", 100)
        monkeypatch.setattr(distance_sums, "SHARES", 500)
    elif kind == "copies":
        x = np.round(x)
    elif kind == "line":
        x = x[:, :1] * [1.0, 2.0, -1.0]
    elif kind == "axes":
        x = rng.normal(0, 1, (300, 70))
    elif kind == "null":
        x[3, 1] = np.nan
    weights = rng.uniform(0, 2, (len(x), 3))
    sums, share, error = summed(x, x, weights, 100)
    exact = brute_force(x, x, weights)
    assert np.isnan(sums).all() if kind == "null" else np.abs(sums / exact - 1).max() < 1e-12
    if kind in ("apart", "copies"):
        assert error and share < 0.8


def test_silhouette_limits_allow_for_far_points(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(0, 1, 6000) + 40 * (np.arange(6000) % 3), np.round(rng.normal(0, 2, 6000))])
    labels = np.where(np.arange(6000) % 3 == 2, np.arange(6000) % 2, 5)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(label=labels))
    sums = brute_force(x, x, (labels[:, None] == [0, 1, 5]).astype(float))
    own, size = np.searchsorted([0, 1, 5], labels), np.array([(labels == c).sum() for c in (0, 1, 5)])
    at = np.arange(6000), own
    a, b = sums[at] / (size[own] - 1), sums / size
    b[at] = np.inf
    exact = ((b.min(axis=1) - a) / np.maximum(a, b.min(axis=1))).mean()
    row = silhouette.silhouette_euclidean(df, ["a", "b"], "label").first()
    assert (row.n, row.silhouette) == (6000, pytest.approx(exact, abs=1e-11))
    assert row.lower <= exact <= row.upper and 1e-11 < row.upper - row.lower < 5e-10
