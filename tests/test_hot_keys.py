"""Frequent-items sketches and joins that spread hot keys, against plain counts and joins."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwise.operators import hot_keys
from cartwise.operators.hot_keys import default_share, frequent_keys, hot_join

SHARE = 1 / 8


@pytest.fixture
def fixed_partitions(spark):
    """Partitions as planned, so that their rows can be counted."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def facts(spark, n, name, equal=False):
    """A third of the rows on one key, a fortieth without one; with ``equal``, the rows of the hot key are all alike."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 40 != 1, F.col("id") % 997)
    value = F.when(F.lit(equal) & (F.col("id") % 3 == 0), 0).otherwise(F.col("id"))
    return spark.range(0, n, numPartitions=8).select(key.cast("long").alias("k"), value.alias(name))


def test_frequent_keys_hold_every_key_of_the_share(spark):
    ids = spark.range(0, 100_000, numPartitions=16)
    # Key i holds about 100,000 / 2^(i + 1) rows; the rest are rare.
    df = ids.select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(-F.floor(F.log2(F.col("id") + 1))).cast("long").alias("k"))
    counts = Counter(r.k for r in df.collect())
    for share in (0.2, 0.01, 0.001):
        found = {r.k: r.n_rows for r in frequent_keys(df, "k", share).collect()}
        assert {k for k, n in counts.items() if n >= share * 100_000} <= set(found)
        assert all(counts[k] <= n <= counts[k] + share * 25_000 for k, n in found.items())
        assert len(found) <= 2 / share


def test_frequent_keys_of_nothing(table):
    assert frequent_keys(table([], "k string"), "k", SHARE).collect() == []
    assert frequent_keys(table([(None,)] * 5, "k string"), "k", SHARE).collect() == []
    with pytest.raises(ValueError):
        frequent_keys(table([], "k string"), "k", 0.0)


@pytest.fixture(params=[0, 60, 100_000])
def broadcast_rows(request, monkeypatch):
    """None, some and all of the hot keys' rows are broadcast."""
    monkeypatch.setattr(hot_keys, "MOST_BROADCAST", request.param)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("equal", [False, True])
def test_hot_join_equals_the_plain_join(spark, how, equal, broadcast_rows):
    left, right = facts(spark, 3_000, "a", equal), facts(spark, 300, "b", equal)
    assert rows(hot_join(left, right, "k", how, SHARE)) == rows(left.join(right, "k", how))


@pytest.mark.parametrize("most", [0, 2, 1_000])
def test_few_rows_of_either_side_are_broadcast(spark, most, monkeypatch):
    monkeypatch.setattr(hot_keys, "MOST_BROADCAST", most)
    few = spark.range(0, 20).select(F.col("id").alias("k"), F.col("id").alias("c"))
    many = facts(spark, 2_000, "a")
    for left, right in ((few, many), (many, few)):
        assert rows(hot_join(left, right, "k", "inner", SHARE)) == rows(left.join(right, "k"))
        assert rows(hot_join(left, right, "k", "left", SHARE)) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_without_partner(spark, how):
    left = facts(spark, 3_000, "a")
    right = facts(spark, 300, "b").where("k <> 7")
    assert rows(hot_join(left, right, "k", how, SHARE)) == rows(left.join(right, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_join_of_empty_and_even_tables(spark, table, how):
    empty, even = table([], "k long, b long"), spark.range(0, 500).select(F.col("id").alias("k"), F.col("id").alias("b"))
    left = facts(spark, 600, "a")
    for right in (empty, even):
        assert rows(hot_join(left, right, "k", how, SHARE)) == rows(left.join(right, "k", how))
    assert hot_join(empty.withColumnRenamed("b", "a"), even, "k", how, SHARE).count() == 0
    with pytest.raises(ValueError):
        hot_join(left, even, "k", "full")


def test_text_keys_and_dotted_columns(table):
    left = table([("x", 1)] * 9 + [("y", 2), (None, 3)], "k string, `a.b` int")
    right = table([("x", 1.5), ("x", 2.5)], "k string, c double")
    found = hot_join(left.withColumnRenamed("a.b", "a"), right, "k", "left", SHARE)
    assert rows(found) == rows(left.withColumnRenamed("a.b", "a").join(right, "k", "left"))


@pytest.mark.parametrize("most", [0, 100_000])
@pytest.mark.parametrize("equal", [False, True])
def test_no_task_has_three_times_the_median(fixed_partitions, equal, most, monkeypatch):
    spark = fixed_partitions
    monkeypatch.setattr(hot_keys, "MOST_BROADCAST", most)
    left = facts(spark, 240_000, "a", equal)
    right = spark.range(0, 997).select(F.col("id").alias("k"), F.col("id").alias("b"))
    joined = hot_join(left, right, "k", "inner", default_share(spark))
    assert joined.count() == left.join(right, "k").count()
    # Partitions of the two halves of the union, cold and hot, by their rows.
    sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    plain = sorted(r["count"] for r in left.join(right, "k").groupBy(F.spark_partition_id()).count().collect())
    assert plain[-1] > 3 * plain[len(plain) // 2]


def test_both_sides_hot_meet_in_a_grid(fixed_partitions, monkeypatch):
    spark = fixed_partitions
    monkeypatch.setattr(hot_keys, "MOST_BROADCAST", 500)
    left, right = facts(spark, 3_000, "a"), facts(spark, 3_000, "b")
    joined = hot_join(left, right, "k", "inner", SHARE)
    sizes = sorted(r["count"] for r in joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[4]
    assert sum(sizes) == left.where("k = 7").count() * right.where("k = 7").count()
