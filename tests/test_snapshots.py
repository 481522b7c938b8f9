"""Snapshot tables and refreshed views: what is rewritten, what readers see, and failures half-way."""

import pytest
from pyspark.sql import functions as F

from cartwise.operators import rows
from cartwise.plans import refresh, views
from cartwise.sources import snapshots


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def values(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def numbers(spark, n=200):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def test_upsert_of_one_key_rewrites_one_partition(spark, table, path):
    first = snapshots.overwrite(numbers(spark), path, ["k"], partitions=8)
    assert len(first.folders) == 8
    second = snapshots.upsert(path, table([(5, -1), ], "k long, v long"))
    changed = {p for p in first.folders if first.folders[p] != second.folders[p]}
    assert len(changed) == 1
    expected = numbers(spark).withColumn("v", F.when(F.col("k") == 5, -1).otherwise(F.col("v")))
    assert values(snapshots.read(spark, path)) == values(expected)
    assert values(snapshots.read(spark, path, 1)) == values(numbers(spark))


def test_changes_read_only_the_partitions_of_their_keys(spark, table, path):
    first = snapshots.overwrite(numbers(spark), path, ["k"], partitions=8)
    asked = table([(5,), (5,), (999,)], "k long")
    found = snapshots.read_keys(spark, path, asked)
    assert values(found) == [(5, 50)]
    read = {f.rsplit("_part=", 1)[1].split("/")[0] for f in found.inputFiles() if "_part=" in f}
    assert len(read) <= 2 < len(first.folders)


def test_delete_update_and_append_match_plain_operators(spark, table, path):
    base = numbers(spark, 60)
    snapshots.overwrite(base, path, ["k"], partitions=4)
    gone = table([(1,), (2,), (2,), (500,)], "k long")
    changes = table([(3, 0), (4, None), (700, 1)], "k long, v long")
    added = table([(1000, 1), (1000, 1), (None, 2)], "k long, v long")
    snapshots.delete(path, gone)
    snapshots.update_column(path, changes, "v")
    before = snapshots.manifest(spark, path)
    after = snapshots.append(path, added)
    assert all(set(listed) <= set(after.folders[p]) for p, listed in before.folders.items())
    expected = rows.update_column(base.join(gone.distinct(), "k", "left_anti"), changes, "k", "v").unionByName(added)
    assert values(snapshots.read(spark, path)) == values(expected)


def test_append_missing_keeps_what_is_there(spark, table, path):
    snapshots.overwrite(numbers(spark, 3), path, ["k"], partitions=4)
    snapshots.append_missing(path, table([(1,), (7,), (7,), (None,)], "x int"), v=-5)
    assert values(snapshots.read(spark, path)) == [(0, 0), (1, 10), (2, 20), (7, -5)]


def test_failed_write_leaves_the_old_version(spark, table, path):
    snapshots.overwrite(numbers(spark), path, ["k"], partitions=4)
    fails = lambda held, new: held.withColumn("v", F.when(F.col("k") == 5, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        snapshots.change(path, table([(5, 1)], "k long, v long"), fails)
    assert snapshots.versions(spark, path) == [1]
    assert values(snapshots.read(spark, path)) == values(numbers(spark))


def test_a_change_cannot_move_rows_to_other_partitions(spark, table, path):
    snapshots.overwrite(numbers(spark), path, ["k"], partitions=16)
    with pytest.raises(ValueError, match="other partitions"):
        snapshots.change(path, table([(5, 1)], "k long, v long"), lambda held, new: held.withColumn("k", F.col("k") + 1))
    assert snapshots.versions(spark, path) == [1]


def test_overwrite_from_itself_and_open_readers(spark, path):
    snapshots.overwrite(numbers(spark), path, ["k"], partitions=4)
    reader = snapshots.read(spark, path)
    snapshots.overwrite(reader.where("k < 10"), path, ["k"], partitions=2)
    assert snapshots.read(spark, path).count() == 10
    assert reader.count() == 200


def test_second_writer_of_a_version_is_refused(spark, table, path):
    snapshots.overwrite(numbers(spark), path, ["k"], partitions=4)

    def overtaken(held, new):
        snapshots.delete(path, table([(1,)], "k long"))
        return held

    with pytest.raises(snapshots.Conflict):
        snapshots.change(path, table([(5, 1)], "k long, v long"), overtaken)
    assert values(snapshots.read(spark, path)) == values(numbers(spark).where("k <> 1"))


def test_expire_keeps_what_the_last_version_uses(spark, table, path, tmp_path):
    snapshots.overwrite(numbers(spark), path, ["k"], partitions=4)
    snapshots.upsert(path, table([(5, -1)], "k long, v long"))
    snapshots.upsert(path, table([(5, -2)], "k long, v long"))
    folders = lambda: len(list((tmp_path / "table" / "data").glob("*/_part=*")))
    assert folders() == 6
    assert snapshots.expire(spark, path) == [1, 2]
    assert folders() == 4 and snapshots.versions(spark, path) == [3]
    assert snapshots.read(spark, path).where("k = 5").first().v == -2
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path, 1)
    with pytest.raises(ValueError):
        snapshots.expire(spark, path, 0)


def test_empty_tables_and_wrong_keys(spark, table, path):
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path)
    snapshots.overwrite(table([], "k long, `a.b` string"), path, ["k"], partitions=4)
    assert snapshots.read(spark, path).columns == ["k", "a.b"] and snapshots.read(spark, path).count() == 0
    assert snapshots.delete(path, table([], "k long")).version == 1
    snapshots.append(path, table([(1, "x")], "k long, `a.b` string"))
    assert values(snapshots.read(spark, path).toDF("k", "v")) == [(1, "x")]
    with pytest.raises(TypeError):
        snapshots.delete(path, table([(1,)], "k int"))


def test_one_hot_key_is_written_by_several_tasks(spark, path, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = spark.range(0, 60_000, numPartitions=8).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("v"))
        snapshots.overwrite(hot, path, ["k"], partitions=4)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(list((tmp_path / "table" / "data").glob("*/_part=*/*.parquet"))) > 1
    assert snapshots.read(spark, path).count() == 60_000


ORDERS = "order_id long, customer_id string, order_purchase_timestamp timestamp_ntz"


def orders_of(spark, days):
    """Order i on day i, by account i mod 5; account 4 is unknown."""
    return spark.range(days.start, days.stop).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 5).cast("string").alias("customer_id"),
        (F.lit("2017-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("order_purchase_timestamp"),
    )


@pytest.fixture
def customers(table):
    people = [(str(i), f"p{i // 2}" if i < 3 else None, "SP" if i % 2 else "RJ") for i in range(4)]
    return table(people, "customer_id string, customer_unique_id string, customer_state string")


def test_months_of_two_loads_equal_the_view_over_both(spark, customers, path):
    assert refresh.load_months(path, orders_of(spark, range(0, 45)), customers, 1)
    assert refresh.load_months(path, orders_of(spark, range(45, 80)), customers, 2)
    assert not refresh.load_months(path, orders_of(spark, range(45, 80)), customers, 2)
    assert not refresh.load_months(path, orders_of(spark, range(0, 45)), customers, 1)
    both = orders_of(spark, range(0, 80))
    assert values(snapshots.read(spark, path)) == values(views.person_months(both, customers))
    assert values(refresh.new_customers_month(spark, path)) == values(views.new_customers_month(both, customers))
    assert values(refresh.repurchases_month(spark, path)) == values(views.repurchases_month(both, customers))


def test_persons_of_two_loads_equal_the_view_over_both(spark, customers, path):
    items = lambda days: spark.range(days.start, days.stop).where("id % 7 <> 0").select(
        F.col("id").alias("order_id"), F.lit("x").alias("product_id"), (F.col("id") * 0.5).cast("double").alias("price")
    )
    for load, days in ((1, range(0, 3)), (2, range(3, 60))):
        refresh.load_persons(path, orders_of(spark, days), customers, items(days), load)
    both = orders_of(spark, range(0, 60)), customers, items(range(0, 60))
    assert values(refresh.last_frequency_monetary(spark, path)) == values(views.last_frequency_monetary(*both))
    assert values(refresh.rfm(spark, path)) == values(views.rfm(*both))
    assert values(refresh.customer_margin(spark, path)) == values(views.customer_margin(*both))


def test_a_load_without_orders_is_remembered(spark, customers, path):
    refresh.load_months(path, orders_of(spark, range(0, 10)), customers, 1)
    assert refresh.load_months(path, orders_of(spark, range(0, 0)), customers, 2)
    assert not refresh.load_months(path, orders_of(spark, range(0, 10)), customers, 2)


def test_a_refresh_touches_only_the_persons_met(spark, customers, path):
    refresh.load_months(path, orders_of(spark, range(0, 40)), customers, 1)
    first = snapshots.manifest(spark, path)
    refresh.load_months(path, orders_of(spark, range(40, 41)), customers, 2)
    second = snapshots.manifest(spark, path)
    assert sum(first.folders[p] != second.folders.get(p) for p in first.folders) == 1
