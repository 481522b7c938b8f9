"""Numeric operators against hand-worked values and brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwise.operators import distance_tree, distinct, kmeans, knn, quantiles, scaling, segments, silhouette
from cartwise.operators.knn import knn_impute
from cartwise.operators.quantiles import approximate_quantiles, exact_quantiles, quantile_table
from cartwise.plans import clustering

RFM = clustering.FEATURES


# --- Quantiles, medians, scores ----------------------------------------------------------------


@pytest.mark.parametrize("seed", [0, 1])
def test_quantiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame(
        {
            "g": rng.integers(0, 3, 4000),
            "heavy": np.round(np.exp(rng.normal(3, 3, 4000)), 2),  # wide range
            "tied": np.where(rng.random(4000) < 0.4, 7.0, rng.integers(0, 50, 4000)),  # one hot value
        }
    )
    probabilities = [0, 0.1, 0.25, 0.5, 0.777, 1]
    df = spark.createDataFrame(frame).repartition(8)
    found = exact_quantiles(df, ["heavy", "tied"], probabilities)
    for c in ("heavy", "tied"):
        assert found[c] == pytest.approx(list(np.quantile(frame[c], probabilities)), rel=1e-12)
    grouped = {r.g: r.value for r in quantile_table(df, ["heavy"], [0.5], by="g").collect()}
    for g, part in frame.groupby("g"):
        assert grouped[g] == pytest.approx(part["heavy"].median(), rel=1e-12)


def test_quantiles_with_infinities_and_extremes(table):
    inf, nan = float("inf"), float("nan")
    values = [*map(float, range(10)), inf, -inf, -inf, nan, None, 1.7e308, -1.7e308, 5e-324]
    data = table([(v,) for v in values], "x double")
    present = sorted(v for v in values if v is not None and v == v)
    probabilities = [i / (len(present) - 1) for i in range(len(present))]
    assert exact_quantiles(data, ["x"], probabilities)["x"] == present
    assert exact_quantiles(data.filter("x IS NULL"), ["x"], [0.5]) == {}


def test_quantiles_of_small_groups_need_no_sketch(spark, monkeypatch):
    rng = np.random.default_rng(13)
    frame = pd.DataFrame({"g": np.append(rng.integers(0, 300, 3000), np.full(5000, 300)).astype(float), "x": np.round(rng.normal(0, 9, 8000)), "y": rng.normal(0, 1, 8000)})
    frame.loc[frame.g == 7, "x"] = np.inf
    frame.loc[:400, "y"] = np.nan
    rows = [(None if g == 5 else g, x, y) for g, x, y in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "g double, x double, y double").repartition(4)
    sketched = []
    of_large = quantiles._of_large
    monkeypatch.setattr(quantiles, "_of_large", lambda values, p: sketched.append(values.select("g").distinct().collect()) or of_large(values, p))
    found = {(r.g, r.c, r.p): r.value for r in quantile_table(df, ["x", "y"], [0, 0.3, 0.5, 1], by="g").collect()}
    assert [[r.g for r in groups] for groups in sketched] == [[300.0]]
    expected = {}
    for g, part in frame.groupby("g"):
        for c in ("x", "y"):
            present = part[c].dropna()
            for i, p in enumerate([0, 0.3, 0.5, 1] if len(present) else []):
                expected[None if g == 5 else g, c, i] = np.inf if g == 7 and c == "x" else np.quantile(present, p)
    assert found == pytest.approx(expected, rel=1e-12)


def test_quantiles_of_large_groups_from_brackets(spark, monkeypatch):
    rng = np.random.default_rng(12)
    x = np.concatenate([np.exp(rng.normal(0, 4, 30_000)), np.full(9_000, 2.5), [-np.inf, np.inf, np.inf, 0.0, -0.0]])
    frame = pd.DataFrame({"x": x, "g": rng.integers(0, 2, len(x))})
    df = spark.createDataFrame(frame).repartition(6)
    probabilities = [0, 0.001, 0.2, 0.5, 0.77777, 0.9999, 1]
    exact = [np.quantile(x, p) for p in probabilities]
    reads = []
    counted = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *a: reads.append(1) or counted(*a))
    assert exact_quantiles(df, ["x"], probabilities)["x"][1:-1] == pytest.approx(exact[1:-1], rel=1e-12)
    assert len(reads) == 1  # no bracket missed its rank
    monkeypatch.setattr(quantiles, "BUCKETS", 8)  # many passes over what was counted
    assert exact_quantiles(df, ["x"], probabilities)["x"][1:-1] == pytest.approx(exact[1:-1], rel=1e-12)
    monkeypatch.setattr(quantiles, "REACH", 0.0)  # brackets too narrow for most ranks are widened
    monkeypatch.setattr(quantiles, "ACCURACY", 20)
    assert exact_quantiles(df, ["x"], probabilities)["x"][1:-1] == pytest.approx(exact[1:-1], rel=1e-12)


def test_approximate_quantiles_keep_their_error(spark):
    x = np.random.default_rng(13).permutation(20_000).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": x % 2})).repartition(7)
    probabilities = [0.01, 0.25, 0.5, 0.9]
    for error in (0.05, 0.001):
        rows = approximate_quantiles(df, ["x"], probabilities, error).collect()
        assert sorted(r.p for r in rows) == [0, 1, 2, 3]
        assert all(abs(r.value - probabilities[r.p] * 20_000) <= error * 20_000 + 1 for r in rows)
    grouped = approximate_quantiles(df, ["x"], [0.5], 0.01, by="g").collect()
    assert len(grouped) == 2 and all(abs(r.value - 10_000) <= 202 for r in grouped)
    with pytest.raises(ValueError):
        approximate_quantiles(df, ["x"], [0.5], 0)


def test_medians_of_many_groups(spark):
    rows = spark.range(30000).selectExpr("id % 1500 AS g", "CASE WHEN id % 1500 <> 7 THEN CAST(id AS DOUBLE) END AS x")
    found = {r.g: r.x for r in segments.median_by_group(rows, "g", ["x"]).collect()}
    assert len(found) == 1500 and found[7] is None
    assert all(found[g] == g + 1500 * 9.5 for g in found if g != 7)


def test_distinct_sketches_merge_like_the_whole(spark):
    df = spark.range(60_000).selectExpr("id % 3 AS part", "id % 20000 AS a", "CASE WHEN id % 2 = 0 THEN id % 7 END AS b")
    parts = distinct.distinct_sketches(df, ["part"], ["a", "b"])
    whole = distinct.estimates(distinct.distinct_sketches(df, [], ["a", "b"]), ["a", "b"]).first()
    merged = distinct.estimates(distinct.merge_sketches(parts, [], ["a", "b"]), ["a", "b"]).first()
    assert merged.b == whole.b == 7
    for row in (merged, whole):
        assert abs(row.a - 20_000) <= 20_000 * distinct.relative_error()
    assert abs(merged.a - whole.a) <= 20_000 * distinct.relative_error()


def test_nan_has_no_score(table):
    data = table([(1.0,), (2.0,), (float("nan"),)], "x double")
    edges = segments.quantile_edges(data, ["x"])["x"]
    assert [r.s for r in data.select("x", segments.quantile_score(F.col("x"), edges).alias("s")).collect() if r.x != r.x] == [None]


def test_median_skips_nulls(table):
    data = table([(0, 1.0), (0, 4.0), (0, None), (1, None), (2, 5.0), (None, 9.0)], "cluster int, x double")
    found = {r.cluster: r.x for r in segments.median_by_group(data, "cluster", ["x"]).collect()}
    assert found[0] == 2.5 and found[1] is None and found[2] == 5.0 and None not in found


def test_quantile_scores_by_hand(table):
    data = table([(1.0,), (2.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    edges = segments.quantile_edges(data, ["x"])["x"]
    scored = data.select("x", segments.quantile_score(F.col("x"), edges).alias("s")).collect()
    assert sorted((r.x, r.s) for r in scored if r.x is not None) == [(1, 1), (2, 2), (2, 2), (3, 4), (10, 5)]
    assert [r.s for r in scored if r.x is None] == [None]


@pytest.mark.parametrize("values", [[1, 1, 1, 1, 2, 3, 4], list(range(37)), [5, 5, 5, 5, 5, 9], [1, 2] * 20 + [8]])
def test_quantile_scores_equal_qcut(table, values):
    data = table([(float(v),) for v in values], "x double")
    edges = segments.quantile_edges(data, ["x"])["x"]
    found = {r.x: r.s for r in data.select("x", segments.quantile_score(F.col("x"), edges).alias("s")).collect()}
    expected = pd.qcut(pd.Series(values, dtype=float), 5, labels=False, duplicates="drop") + 1
    assert found == dict(zip(map(float, values), expected))


def test_reversed_recency_and_segments(table):
    data = table([(float(i), float(i), float(i)) for i in range(1, 11)], "recency double, frequency double, monetary_value double")
    scored = segments.rfm_scores(data, reverse_recency=True)
    assert {(r.R, r.F) for r in scored.collect()} == {(6 - i, i) for i in range(1, 6)}
    counts = segments.segment_counts(segments.rfm_scores(data)).collect()
    assert sum(r["count"] for r in counts) == 10
    assert {r.segment for r in counts} == {str(i) * 3 for i in range(1, 6)}


# --- Imputation --------------------------------------------------------------------------------


def brute_force_impute(rows, k=2):
    """Reference values from all pairs: (key, features) with None for missing."""
    columns = range(len(rows[0][1]))
    result = {}
    for key, x in rows:
        filled = list(x)
        for c in columns:
            if x[c] is not None:
                continue
            near = []
            for other, y in rows:
                shared = [j for j in columns if x[j] is not None and y[j] is not None]
                if y[c] is not None and shared:
                    d = sum((x[j] - y[j]) ** 2 for j in shared) * (len(x) / len(shared))
                    near.append((d, other, y[c]))
            known = [y[c] for _, y in rows if y[c] is not None]
            near = sorted(near)[:k]
            if known:
                filled[c] = np.mean([v for *_, v in near]) if near else np.mean(known)
        result[key] = filled
    return result


def imputed(spark, rows, k=2):
    names = ["r", "f", "m"][: len(rows[0][1])]
    schema = "id int, " + ", ".join(f"{c} double" for c in names)
    df = spark.createDataFrame([(key, *x) for key, x in rows], schema)
    return {r.id: [r[c] for c in names] for r in knn_impute(df, "id", names, k).collect()}


def same(found, expected):
    assert found.keys() == expected.keys()
    for key in expected:
        assert found[key] == pytest.approx(expected[key]), key


def test_impute_by_hand(spark):
    rows = [(1, (1.0, 1.0, 10.0)), (2, (2.0, 1.0, 20.0)), (3, (9.0, 9.0, 90.0)), (4, (1.5, 1.0, None))]
    assert imputed(spark, rows)[4][2] == 15.0


@pytest.mark.parametrize("seed", [0, 1])
def test_impute_whole_numbers_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(400):
        hot = rng.random() < 0.33  # a third of the rows share one point
        x = (5.0, 1.0) if hot else (float(rng.integers(0, 300)), float(rng.integers(1, 6)))
        rows.append((i, (*x, None if rng.random() < 0.2 else float(rng.integers(1, 1000)))))
    same(imputed(spark, rows), brute_force_impute(rows))


def test_impute_far_outliers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (float(rng.integers(0, 40)), float(rng.integers(0, 4)), float(i))) for i in range(200)]
    rows += [(900, (5000.0, 2.0, None)), (901, (-300.0, 1.0, None)), (902, (20.0, 9000.0, None)), (903, (4000.0, 1.0, 5.0))]
    same(imputed(spark, rows), brute_force_impute(rows))


def test_donors_squeezed_by_an_outlier_part_into_small_leaves(spark):
    rng = np.random.default_rng(21)
    points = rng.random((200_000, 2))
    points[0] = 1e12, -1e12  # on an even grid all other donors share one cell
    points[1:50_000, 0] = 0.25  # a hot value of one axis
    frame = pd.DataFrame(points, columns=["a", "b"]).assign(donor=range(len(points)), value=rng.random(len(points)))
    df = spark.createDataFrame(frame).repartition(8)
    cells, placed = knn.partition(df, ["a", "b"], 64)
    sizes = [r["count"] for r in placed.groupBy("cell").count().collect()]
    assert max(sizes) <= 64 and sum(sizes) == 200_000 and len(cells) <= 6
    queries = np.concatenate([rng.random((20, 2)), [[0.25, 0.5], [1e12, 0.0], [-5.0, 5.0]]])
    found = knn.nearest(spark.createDataFrame(pd.DataFrame(queries, columns=["a", "b"])), df, ["a", "b"], 3).collect()
    assert len(found) == 3 * len(queries)
    for q in queries:
        distance = ((points - q) ** 2).sum(1)
        expected = sorted(zip(distance, range(len(points))))[:3]
        near = sorted((r.distance, r.donor) for r in found if (r.q_a, r.q_b) == tuple(q))
        assert [n[1] for n in near] == [e[1] for e in expected]


def test_impute_fractions_and_several_gaps(spark):
    rng = np.random.default_rng(4)

    def gap(value):
        return None if rng.random() < 0.25 else float(value)

    x = np.round(np.exp(rng.normal(0, 2, (150, 3))), 3)
    rows = [(i, (float(r), gap(f), gap(m))) for i, (r, f, m) in enumerate(x)]
    same(imputed(spark, rows, k=3), brute_force_impute(rows, k=3))


def test_impute_fewer_donors_than_neighbours(spark):
    rows = [(1, (1.0, 4.0)), (2, (9.0, None)), (3, (None, None))]
    same(imputed(spark, rows), {1: [1.0, 4.0], 2: [9.0, 4.0], 3: [5.0, 4.0]})


# --- Scaling, inertia, silhouette --------------------------------------------------------------


def test_scale_with_population_deviation(table):
    data = table([(1, 1.0, 7.0), (2, 3.0, 7.0)], "id int, x double, c double")
    assert sorted(tuple(r) for r in scaling.standard_scale(data, ["x", "c"]).collect()) == [(1, -1.0, 0.0), (2, 1.0, 0.0)]


def test_inertia_of_one_cluster(table):
    data = table([(0.0, 0.0, 1.0), (2.0, 0.0, 1.0)], "x double, y double, w double")
    assert scaling.inertia_of_one(data, ["x", "y"]).first().inertia == 2.0
    assert scaling.inertia_of_one(data, ["x", "y"], "w").first().inertia == 2.0


def brute_force_silhouette(x, labels, power):
    distance = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = distance[i, mine].sum() / (mine.sum() - 1)
        b = min(distance[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


@pytest.fixture
def clouds(spark):
    rng = np.random.default_rng(5)
    labels = np.concatenate([np.repeat([0, 1, 2], 150), [3]])  # the last cluster has one member
    x = np.round(rng.normal(0, 1, (451, 3)) + labels[:, None] * 2, 1)
    frame = pd.DataFrame(x, columns=["a", "b", "c"]).assign(label=labels)
    return x, labels, spark.createDataFrame(frame).repartition(4)


def test_silhouettes_equal_all_pairs(clouds):
    x, labels, df = clouds
    squared = silhouette.silhouette_squared(df, ["a", "b", "c"], "label").first()
    assert squared.n == 451 and squared.silhouette == pytest.approx(brute_force_silhouette(x, labels, 2))
    plain = silhouette.silhouette_euclidean(df, ["a", "b", "c"], "label").first()
    exact = pytest.approx(brute_force_silhouette(x, labels, 1))
    assert (plain.n, plain.silhouette, plain.lower, plain.upper) == (451, exact, exact, exact)


def test_silhouette_with_few_cells_brackets_the_exact_one(clouds):
    x, labels, df = clouds
    exact = brute_force_silhouette(x, labels, 1)
    row = silhouette.silhouette_euclidean(df, ["a", "b", "c"], "label", max_cells=260).first()
    assert row.n == 451 and row.lower <= exact <= row.upper
    assert row.silhouette == pytest.approx(exact, abs=0.02)


def test_silhouette_is_exact_at_tolerance_zero_and_bracketed_above(spark, clouds):
    x, labels, df = clouds
    exact = brute_force_silhouette(x, labels, 1)
    row = silhouette.silhouette_euclidean(df, ["a", "b", "c"], "label", max_cells=40).first()
    assert row.silhouette == pytest.approx(exact, abs=1e-9) and row.upper - row.lower < 1e-9
    for tolerance in (0.02, 0.2):
        row = silhouette.silhouette_euclidean(df, ["a", "b", "c"], "label", tolerance=tolerance).first()
        assert row.lower <= exact <= row.upper and row.upper - row.lower <= tolerance + 1e-9
    many = np.sort(np.random.default_rng(6).normal(0, 1, 8500))  # distinct points of one column, in two clusters
    total = np.abs(many[:, None] - many[None, :]) @ np.eye(2)[(many > 0.3).astype(int)]
    own, size = (many > 0.3).astype(int), np.bincount(many > 0.3)
    a, b = total[np.arange(8500), own] / (size[own] - 1), total[np.arange(8500), 1 - own] / size[1 - own]
    row = silhouette.silhouette_euclidean(spark.createDataFrame(pd.DataFrame({"a": many, "label": own})), ["a"], "label").first()
    assert (row.n, row.silhouette) == (8500, pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-9))


def test_exact_silhouette_deals_points_into_bounded_even_shares(spark, clouds, monkeypatch):
    x, labels, df = clouds
    monkeypatch.setattr(silhouette, "OWN", 30)
    monkeypatch.setattr(silhouette, "POINTS", 5)
    monkeypatch.setattr(silhouette, "ROWS", 4)
    dealt = []
    summed = silhouette._summed
    monkeypatch.setattr(silhouette, "_summed", lambda parts: dealt.append(parts.withColumn("task", F.spark_partition_id()).collect()) or summed(parts))
    row = silhouette.silhouette_euclidean(df, ["a", "b", "c"], "label").first()
    assert (row.n, row.silhouette) == (451, pytest.approx(brute_force_silhouette(x, labels, 1), abs=1e-9))
    tasks = [r.task for r in dealt[0]]
    assert len(tasks) == len(set(tasks)) >= 10  # a share has a task of its own


def test_silhouettes_of_many_clusters(spark):
    rng = np.random.default_rng(7)
    labels = np.repeat(np.arange(130), 4)
    x = np.round(rng.normal(0, 0.5, (520, 2)) + labels[:, None] % 13 * [1, 2] + labels[:, None] // 13, 2)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(label=labels))
    for power, found in ((1, silhouette.silhouette_euclidean), (2, silhouette.silhouette_squared)):
        assert found(df, ["a", "b"], "label").first().silhouette == pytest.approx(brute_force_silhouette(x, labels, power))


def test_limits_of_nodes_bracket_every_mean_distance():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 3, (40, 2)), np.zeros((1, 2))])
    nodes, exact = [], []
    for scale in (0.0, 0.01, 0.5, 4.0):
        y, w = rng.normal(0, 1, (30, 2)) * scale + rng.normal(0, 2, 2), rng.integers(1, 4, 30)
        c = w @ y / w.sum()
        h = y - c
        cov = (w[:, None, None] * h[:, :, None] * h[:, None, :]).sum(0) / w.sum()
        nodes.append([w.sum(), *c, np.sqrt((h * h).sum(1)).max(), cov[0, 0], cov[0, 1], cov[1, 1]])
        exact.append(np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1)) @ w / w.sum())
    low, high = distance_tree.limits(x, np.array(nodes))
    assert (low <= np.array(exact).T + 1e-9).all() and (np.array(exact).T <= high + 1e-9).all()
    assert np.allclose(low[:, 0], high[:, 0]) and (high - low)[:, 1].max() < 1e-4


def test_silhouette_trees_with_outlier_copies_nulls_and_two_labellings(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(0, 1, (1200, 2)), 3)
    x[:300] += 3
    x[0] = 1e7, 1e7  # all other points fall into one small cube of the upper levels
    x[1100:] = x[100:200]  # copies
    first, second = np.repeat([0, 1, 2], [300, 500, 400]), np.arange(1200) % 2
    second[x[:, 0] > 2] = 2
    frame = pd.DataFrame(x, columns=["a", "b"]).assign(one=first, two=second)
    df = spark.createDataFrame(frame).withColumn("one", F.when(F.col("one") > 0, F.col("one")))  # null is a cluster
    rows = silhouette.silhouettes_euclidean(df, ["a", "b"], ["one", "two"], tolerance=0.001).collect()
    assert {r.label for r in rows} == {"one", "two"}
    for row in rows:
        exact = brute_force_silhouette(x, first if row.label == "one" else second, 1)
        assert row.n == 1200 and row.lower - 1e-9 <= exact <= row.upper + 1e-9 and row.upper - row.lower <= 0.001


def test_silhouette_trees_of_many_clusters_and_few_points(spark):
    rng = np.random.default_rng(7)
    labels = np.repeat(np.arange(130), 4)
    labels[0] = 130  # alone
    x = np.round(rng.normal(0, 0.5, (520, 2)) + labels[:, None] % 13 * [1, 2] + labels[:, None] // 13, 2)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(label=labels))
    row = silhouette.silhouette_euclidean(df, ["a", "b"], "label", tolerance=0.001).first()
    assert row.silhouette == pytest.approx(brute_force_silhouette(x, labels, 1), abs=0.001)
    same = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "a double, label int")
    assert silhouette.silhouette_euclidean(same, ["a"], "label", tolerance=0.1).first().silhouette == 0
    with pytest.raises(ValueError):
        silhouette.silhouette_euclidean(same.filter("label = 1"), ["a"], "label", tolerance=0.1)


def test_silhouette_on_weighted_points(clouds):
    x, labels, df = clouds
    weighted = df.groupBy("a", "b", "c", "label").agg(F.count("*").cast("double").alias("w"))
    squared = silhouette.silhouette_squared(weighted, ["a", "b", "c"], "label", "w").first()
    assert squared.silhouette == pytest.approx(brute_force_silhouette(x, labels, 2))


# --- k-means -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def prepared(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        group = i % 4
        money = None if i % 50 == 7 else float(np.round(group * 1000 + rng.normal(0, 30), 2))
        rows.append((i, float(group * 100 + rng.integers(0, 20)), float(1 + group * 5 + rng.integers(0, 2)), money))
    rfm = spark.createDataFrame(rows, "customer_unique_id int, recency double, frequency double, monetary_value double")
    return clustering.prepare(rfm)


def test_prepared_features(prepared):
    stats = prepared.table.agg(
        F.count("*").alias("n"),
        F.count("monetary_value").alias("raw"),
        *[F.avg(c).alias(f"avg_{c}") for c in clustering.SCALED],
        *[F.stddev_pop(c).alias(f"sd_{c}") for c in clustering.SCALED],
    ).first()
    assert (stats.n, stats.raw) == (300, 294)
    for c in clustering.SCALED:
        assert stats[f"avg_{c}"] == pytest.approx(0, abs=1e-9) and stats[f"sd_{c}"] == pytest.approx(1)


def test_four_clear_groups(prepared):
    model, labelled = clustering.segment(prepared, k=4)
    rows = labelled.collect()
    assert len(rows) == 300
    assert model.centers == sorted(model.centers)
    for group in range(4):
        assert {r.cluster for r in rows if r.customer_unique_id % 4 == group} == {group}
    medians = {r.cluster: r for r in clustering.cluster_profile(labelled).collect()}
    frame = pd.DataFrame([r.asDict() for r in rows])
    for cluster, row in frame.groupby("cluster")[RFM].median().iterrows():
        assert [medians[cluster][c] for c in RFM] == pytest.approx(list(row))


def test_fit_is_a_fixed_point(prepared):
    """Each centre is the mean of its own points, and each point has its nearest centre."""
    model, _ = clustering.segment(prepared, k=3)
    frame = model.label(prepared.table).toPandas()
    x = frame[clustering.SCALED].to_numpy()
    centers = np.array(model.centers)
    distance = ((x[:, None] - centers[None]) ** 2).sum(-1)
    assert (distance.argmin(1) == frame["cluster"].to_numpy()).all()
    assert model.inertia == pytest.approx(distance.min(1).sum())
    for c in range(3):
        assert x[frame["cluster"] == c].mean(0) == pytest.approx(centers[c], abs=1e-2)


@pytest.mark.parametrize("partitions", [2, 5])
def test_fit_does_not_depend_on_the_partitioning(prepared, partitions):
    points = prepared.points
    one = kmeans.fit_many(points, clustering.SCALED, [3, 6])
    other = kmeans.fit_many(points.repartition(partitions), clustering.SCALED, [3, 6])
    assert {k: m.centers for k, m in one.items()} == {k: m.centers for k, m in other.items()}


def test_sweep(prepared):
    rows = {r.k: r for r in clustering.sweep(prepared, range(2, 6)).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[1].inertia == pytest.approx(900) and rows[1].silhouette is None
    assert all(rows[k].inertia <= rows[1].inertia for k in rows)
    assert max((rows[k].silhouette, k) for k in (2, 3, 4, 5))[1] == 4


def test_weighted_points_keep_the_objective(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (1.0,), (9.0,), (10.0,)], "x double")
    points = kmeans.weighted_points(df, ["x"])
    assert points.count() == 4
    assert kmeans.fit(points, ["x"], 2).inertia == pytest.approx(2 / 3 + 0.5)
