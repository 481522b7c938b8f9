"""The marketplace tables as derived from the star-schema test tables.

Every table exists twice: as a DataFrame and as a common table expression, so the
checking SQL starts from the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2002-01-01 00:00:00"

# English term -> French translation; two of the terms are left out on purpose.
DICTIONARY = [("economy", "économique"), ("large", "grand"), ("medium", "moyen"), ("small", "petit")]


def _two_digits(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 2, "0")


def _zip(nation: str, balance: str) -> Column:
    block = F.floor((F.col(balance) + 1000) / 110).cast("int").cast("string")
    return F.concat(_two_digits(nation), F.lpad(block, 2, "0"))


def _days(ts: str, days: int) -> Column:
    return F.col(ts) + F.make_dt_interval(F.lit(days))


class Roles:
    """Lazy access to the tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return self.base("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.expr("c_custkey div 2").alias("customer_unique_id"),  # a person holds two accounts
            _zip("c_nationkey", "c_acctbal").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            _two_digits("c_nationkey").alias("customer_state"),
        )

    @cached_property
    def brazil_states(self) -> DataFrame:
        nation, region = self.base("nation"), self.base("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            _two_digits("n_nationkey").alias("abbreviation"), F.col("n_name").alias("state"), F.col("r_name").alias("region")
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.base("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            _days("o_orderdate", 1).alias("order_approved_at"),
            _days("o_orderdate", 3).alias("order_delivered_carrier_date"),
            _days("o_orderdate", 9).alias("order_delivered_customer_date"),
            _days("o_orderdate", 14).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment_value"),
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        """Before the removal of repeated review ids."""
        return self.base("lineitem").select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_returnflag").alias("review_comment_title"),
            F.col("l_linestatus").alias("review_comment_message"),
            F.col("l_shipdate").alias("review_creation_date"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.base("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.col("p_size").cast("double").alias("product_name_lenght"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self.base("supplier").select(
            F.col("s_suppkey").alias("seller_id"),
            _zip("s_nationkey", "s_acctbal").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            _two_digits("s_nationkey").alias("seller_state"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """Raw points: several per zip, some of them repeated, some on the zero meridian."""
        return self.base("customer").select(
            _zip("c_nationkey", "c_acctbal").alias("geolocation_zip_code_prefix"),
            (F.lit(-20.0) + F.col("c_nationkey") + F.floor((F.col("c_acctbal") + 1000) / 55) * F.lit(0.01)).alias(
                "geolocation_lat"
            ),
            (F.lit(-7.5) + (F.ascii("c_mktsegment") - 65) * F.lit(1.5)).alias("geolocation_lng"),
            F.col("c_mktsegment").alias("geolocation_city"),
            _two_digits("c_nationkey").alias("geolocation_state"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        return (
            self.base("part")
            .select(
                F.col("p_type").alias("product_category_name"),
                F.lower("p_type").alias("product_category_name_english"),
            )
            .distinct()
        )

    @cached_property
    def dictionary(self) -> DataFrame:
        return self.spark.createDataFrame(DICTIONARY, "term string, translation string")


def _sql_zip(nation: str, balance: str) -> str:
    block = f"CAST(CAST(floor(({balance} + 1000) / 110) AS INTEGER) AS VARCHAR)"
    return f"lpad(CAST({nation} AS VARCHAR), 2, '0') || lpad({block}, 2, '0')"


SQL_ROLES = {
    "customers": f"""SELECT c_custkey AS customer_id, c_custkey // 2 AS customer_unique_id,
        {_sql_zip("c_nationkey", "c_acctbal")} AS customer_zip_code_prefix, c_mktsegment AS customer_city,
        lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS customer_state FROM customer""",
    "states": """SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS abbreviation, n_name AS state, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "purchases": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
        o_orderdate AS order_purchase_timestamp, o_orderdate + INTERVAL 1 DAY AS order_approved_at,
        o_orderdate + INTERVAL 3 DAY AS order_delivered_carrier_date,
        o_orderdate + INTERVAL 9 DAY AS order_delivered_customer_date,
        o_orderdate + INTERVAL 14 DAY AS order_estimated_delivery_date FROM orders""",
    "items": """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
        l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price FROM lineitem""",
    "payments": """SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
        l_extendedprice * (1 - l_discount) AS payment_value FROM lineitem""",
    "reviews": """SELECT l_orderkey || '-' || l_linenumber AS review_id, l_orderkey AS order_id,
        l_returnflag AS review_comment_title, l_linestatus AS review_comment_message,
        l_shipdate AS review_creation_date FROM lineitem""",
    "products": """SELECT p_partkey AS product_id, p_type AS product_category_name,
        CAST(p_size AS DOUBLE) AS product_name_lenght FROM part""",
    "sellers": f"""SELECT s_suppkey AS seller_id, {_sql_zip("s_nationkey", "s_acctbal")} AS seller_zip_code_prefix,
        s_name AS seller_city, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS seller_state FROM supplier""",
    "geolocation": f"""SELECT {_sql_zip("c_nationkey", "c_acctbal")} AS geolocation_zip_code_prefix,
        -20.0::DOUBLE + c_nationkey + floor((c_acctbal + 1000) / 55) * 0.01::DOUBLE AS geolocation_lat,
        -7.5::DOUBLE + (ascii(c_mktsegment) - 65) * 1.5::DOUBLE AS geolocation_lng,
        c_mktsegment AS geolocation_city, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS geolocation_state
        FROM customer""",
    "translation": """SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
        FROM part""",
    "dictionary": "SELECT * FROM (VALUES "
    + ", ".join(f"('{term}', '{word}')" for term, word in DICTIONARY)
    + ") AS d(term, translation)",
    # Derived tables that several checks share.
    "clean_reviews": "SELECT * FROM reviews QUALIFY count(*) OVER (PARTITION BY review_id) = 1",
    "clean_points": """SELECT * FROM geolocation QUALIFY count(*) OVER (
        PARTITION BY geolocation_zip_code_prefix, geolocation_lat, geolocation_lng) = 1""",
    "centroids": """SELECT geolocation_zip_code_prefix, avg(geolocation_lat) AS geolocation_lat,
        avg(geolocation_lng) AS geolocation_lng, max(geolocation_city) AS geolocation_city,
        max(geolocation_state) AS geolocation_state, CAST(count(*) AS INTEGER) AS n
        FROM clean_points GROUP BY geolocation_zip_code_prefix""",
    "customer_filled": """SELECT * FROM centroids UNION ALL
        SELECT DISTINCT customer_zip_code_prefix, NULL::DOUBLE, NULL::DOUBLE, NULL, NULL, 0 FROM customers
        WHERE customer_zip_code_prefix NOT IN (SELECT geolocation_zip_code_prefix FROM centroids)""",
    "located": """SELECT * FROM customer_filled UNION ALL
        SELECT DISTINCT seller_zip_code_prefix, NULL::DOUBLE, NULL::DOUBLE, NULL, NULL, 0 FROM sellers
        WHERE seller_zip_code_prefix NOT IN (SELECT geolocation_zip_code_prefix FROM customer_filled)""",
    "placed": """SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, region
        FROM customers LEFT JOIN states ON customer_state = abbreviation""",
    "placed_orders": """SELECT order_id, customer_id, customer_unique_id, order_purchase_timestamp,
        customer_zip_code_prefix, customer_city, customer_state, region FROM purchases LEFT JOIN placed USING (customer_id)""",
    "order_totals": """SELECT order_id, count(product_id) AS total_items_sold, sum(price) AS total_price
        FROM items GROUP BY order_id""",
    "person_orders": "SELECT * FROM placed_orders LEFT JOIN order_totals USING (order_id)",
    "rfm": f"""SELECT customer_unique_id,
        CAST(date_part('day', TIMESTAMP '{AS_OF}' - max(order_purchase_timestamp)) AS DOUBLE) AS recency,
        count(order_id) AS frequency, sum(total_price) AS monetary_value
        FROM person_orders GROUP BY customer_unique_id""",
    # Every seventh person lacks the monetary value.
    "gappy_rfm": """SELECT customer_unique_id, recency, CAST(frequency AS DOUBLE) AS frequency,
        CASE WHEN customer_unique_id % 7 <> 0 THEN monetary_value END AS monetary_value FROM rfm""",
    "scaled": """SELECT customer_unique_id, (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS recency,
        (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () AS frequency,
        (monetary_value - avg(monetary_value) OVER ()) / stddev_pop(monetary_value) OVER () AS monetary_value FROM rfm""",
}

# Which expressions each one needs.
_NEEDS = {
    "clean_reviews": ["reviews"],
    "clean_points": ["geolocation"],
    "centroids": ["clean_points"],
    "customer_filled": ["centroids", "customers"],
    "located": ["customer_filled", "sellers"],
    "placed": ["customers", "states"],
    "placed_orders": ["purchases", "placed"],
    "order_totals": ["items"],
    "person_orders": ["placed_orders", "order_totals"],
    "rfm": ["person_orders"],
    "gappy_rfm": ["rfm"],
    "scaled": ["rfm"],
}


def with_roles(sql: str, *names: str, **extra: str) -> str:
    """Put the named expressions (and what they need) in front of a statement."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({SQL_ROLES[n]})" for n in ordered] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(parts)} {sql}"
