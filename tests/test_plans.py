"""Shape of the physical plans: what is read, what moves, and how skew is split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from compare import planned
from cartwise.operators import joins, rows
from cartwise.operators.knn import knn_impute
from cartwise.plans import views
from cartwise.session import materialise
from cartwise.testbed.roles import AS_OF, Roles

FOLDER = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def roles(spark):
    return Roles(spark, FOLDER)


def test_rfm_reads_only_its_columns(roles):
    plan = planned(views.rfm(roles.orders, roles.customers, roles.order_items, AS_OF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan


def test_lookup_reaches_the_scan(spark):
    assert "EqualTo(c_name,Customer#000000042)" in planned(entry_points.queries()["keyed_lookup"](spark, FOLDER))


def test_items_combine_before_the_join(no_broadcast, roles):
    """Five shuffles: items per order, orders, account totals, customers, persons."""
    plan = planned(views.rfm(roles.orders, roles.customers, roles.order_items, AS_OF))
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("partial_sum") >= 3


def test_duplicates_count_once(no_broadcast, roles):
    plan = executed(rows.delete_duplicates(roles.order_reviews, ["review_id"]))
    assert plan.count("LeftAnti") == 2
    assert "ReusedExchange" in plan
    assert "TakeOrderedAndProject(limit=1000" in plan


def test_anti_join_moves_distinct_keys(no_broadcast, roles):
    plan = planned(joins.without_match(roles.orders, roles.order_items, "order_id"))
    assert "LeftAnti" in plan and "HashAggregate(keys=[order_id" in plan


@pytest.mark.parametrize("view", ["payments_orders", "orders_customers"])
def test_hot_key_is_split(no_broadcast, view):
    """A third of the rows share one key: the join splits its partition over several tasks."""
    spark = no_broadcast
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
        ids = spark.range(0, 300_000, numPartitions=8)
        if view == "payments_orders":
            payments = ids.select(key.alias("order_id"), F.rand(1).alias("payment_value"))
            orders = ids.select(F.col("id").alias("order_id"), F.col("id").alias("customer_id")).withColumn(
                "order_purchase_timestamp", F.lit(AS_OF).cast("timestamp_ntz")
            )
            df = views.payments_orders(payments, orders)
        else:
            orders = ids.select(F.col("id").alias("order_id"), key.alias("customer_id")).withColumn(
                "order_purchase_timestamp", F.lit(AS_OF).cast("timestamp_ntz")
            )
            customers = ids.select(
                F.col("id").alias("customer_id"),
                F.col("id").alias("customer_unique_id"),
                *[F.lit("x").alias(c) for c in ("customer_zip_code_prefix", "customer_city", "customer_state")],
            )
            states = spark.createDataFrame([("x", "South")], "abbreviation string, region string")
            df = views.orders_customers(orders, customers, states)
        joined_on = "order_id" if view == "payments_orders" else "customer_id"
        assert re.search(rf"SortMergeJoin\(skew=true\) \[{joined_on}", executed(df))
        assert df.count() == 300_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_impute_with_one_point_for_all_donors(spark):
    df = spark.range(0, 20_000, numPartitions=4).select(
        "id", F.lit(1.0).alias("r"), F.lit(2.0).alias("f"), F.when(F.col("id") > 0, F.col("id").cast("double")).alias("m")
    )
    stored = materialise(df, "test")
    filled = knn_impute(stored, "id", ["r", "f", "m"])
    assert filled.where("id = 0").first().m == 1.5
    assert "NestedLoopJoin" not in planned(filled)
