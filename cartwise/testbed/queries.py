"""Every operator and view on the test tables, with the SQL that checks it.

``@query(name, sql)`` registers a function of ``Roles``; without SQL only the rows
are checked. Sums of doubles are rounded on both sides, because the order of
addition differs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions import dates, text
from cartwise.functions.geo import mercator_x, mercator_y
from cartwise.operators import distinct, joins, kmeans, locations, quality, quantiles, rows, scaling, segments, silhouette, translate
from cartwise.operators.hot_keys import frequent_keys, hot_join
from cartwise.operators.knn import knn_impute
from cartwise.plans import clustering, refresh, views
from cartwise.plans.load import load_folder
from cartwise.schemas import ENTITIES
from cartwise.session import materialise, ready, scratch_path, tune
from cartwise.sources import csv_files, snapshots, tables
from cartwise.testbed.roles import AS_OF, Roles, with_roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ZIP, LAT, LNG = locations.ZIP, locations.LAT, locations.LNG
RFM = ["recency", "frequency", "monetary_value"]
PERSON = "customer_unique_id"


def query(name: str, sql: str | None = None):
    def register(function: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Roles(tune(ready(spark)), folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def _nullable_count(df: DataFrame) -> DataFrame:
    """Integers that can be null are compared as doubles: both sides then read them alike."""
    return df.withColumn("total_items_sold", F.col("total_items_sold").cast("double"))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- Sources and sinks -------------------------------------------------------------------------


def _csv_folder(r: Roles) -> str:
    """The raw tables as a folder of CSV files, the shape a load starts from."""
    folder = scratch_path(r.spark, "csv")
    for name in ("customers", "orders", "order_items", "sellers"):
        tables.write_csv(getattr(r, name), f"{folder}/{name}_dataset.csv")
    return folder


@query(
    "ingest_csv_folder",
    with_roles(
        """SELECT 'customers' AS table_name, count(*) AS n_rows, count(customer_zip_code_prefix) AS n_values FROM customers
        UNION ALL SELECT 'orders', count(*), count(order_purchase_timestamp) FROM purchases
        UNION ALL SELECT 'order_items', count(*), count(price) FROM items
        UNION ALL SELECT 'sellers', count(*), count(seller_zip_code_prefix) FROM sellers""",
        "customers",
        "purchases",
        "items",
        "sellers",
    ),
)
def ingest_csv_folder(r):
    typed = {"customers": "customer_zip_code_prefix", "orders": "order_purchase_timestamp"}
    typed |= {"order_items": "price", "sellers": "seller_zip_code_prefix"}
    loaded = csv_files.read_folder(r.spark, _csv_folder(r))
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(typed[name]).alias("n_values")).select(
            F.lit(name).alias("table_name"), "n_rows", "n_values"
        )
        for name, df in loaded.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@query(
    "ingest_csv_file",
    with_roles(
        """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
        order_purchase_timestamp, order_estimated_delivery_date FROM purchases""",
        "purchases",
    ),
)
def ingest_csv_file(r):
    folder = scratch_path(r.spark, "csv")
    tables.write_csv(r.orders, f"{folder}/orders_dataset.csv")
    orders = csv_files.read_folder(r.spark, folder, "orders_dataset.csv")["orders"]
    return orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_estimated_delivery_date"
    )


@query(
    "ingest_zip_as_string",
    with_roles(
        "SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_zip_code_prefix, customer_state FROM customers",
        "customers",
    ),
)
def ingest_zip_as_string(r):
    folder = scratch_path(r.spark, "csv")
    tables.write_csv(r.customers, f"{folder}/customers_dataset.csv")
    customers = csv_files.read_folder(r.spark, folder)["customers"]
    return customers.select("customer_id", "customer_zip_code_prefix", "customer_state")


@query("header_strip", "SELECT c_custkey AS customer_id, c_mktsegment || ' ' AS customer_city FROM customer")
def header_strip(r):
    raw = r.base("customer").select(
        F.col("c_custkey").alias("customer_id "), F.concat("c_mktsegment", F.lit(" ")).alias(" customer_city ")
    )
    return csv_files.strip_header(raw)


@query(
    "na_tokens_to_null",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders""",
)
def na_tokens_to_null(r):
    raw = r.base("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "N/A").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    return csv_files.nulls_from_tokens(raw)


@query(
    "table_name_from_file",
    """SELECT DISTINCT 'orders_' || c_mktsegment || '_dataset.csv' AS file_name, 'orders_' || c_mktsegment AS table_name FROM customer""",
)
def table_name_from_file(r):
    # One file per market segment, listed and named as a load does.
    folder = scratch_path(r.spark, "csv")
    for row in r.base("customer").select("c_mktsegment").distinct().collect():  # a handful of segments
        tables.write_csv(r.base("region"), f"{folder}/orders_{row.c_mktsegment}_dataset.csv")
    names = [(name, csv_files.table_name(name)) for name in csv_files.list_csv(r.spark, folder)]
    return r.spark.createDataFrame(names, "file_name string, table_name string")


def _load(r: Roles) -> dict[str, DataFrame]:
    """A load over files of every kind: parts of one table, a prefix, an unknown table, a byte-order mark."""
    folder = scratch_path(r.spark, "csv")
    old = F.col("o_orderdate") < F.lit("2000-01-01")
    orders = r.orders.join(r.base("orders").select(F.col("o_orderkey").alias("order_id"), old.alias("old")), "order_id")
    tables.write_csv(orders.filter("old").drop("old"), f"{folder}/shop_orders_2000.csv")
    tables.write_csv(orders.filter("NOT old").drop("old"), f"{folder}/shop_orders_dataset.csv")
    tables.write_csv(r.customers, f"{folder}/shop_customers_dataset.csv")
    tables.write_csv(r.order_items.withColumn("freight", F.when(F.col("price") > 1000, F.col("price"))), f"{folder}/shop_order_items_dataset.csv")
    spend = F.when(F.col("s_acctbal") < 0, "NA").otherwise(F.col("s_acctbal").cast("string"))
    campaigns = r.base("supplier").select(F.col("s_suppkey").alias("\ufeffcampaign"), spend.alias("spend"), F.col("s_name").alias(" name "))
    tables.write_csv(campaigns, f"{folder}/best_sellers.csv")
    return load_folder(r.spark, folder, scratch_path(r.spark, "warehouse"))


@query(
    "load_folder_all",
    with_roles(
        """SELECT 'orders' AS table_name, CAST(order_id AS VARCHAR) AS k, CAST(customer_id AS VARCHAR) AS a, order_status AS b,
            CAST(NULL AS DOUBLE) AS x, 'timestamp_ntz' AS kind FROM purchases
        UNION ALL SELECT 'customers', CAST(customer_id AS VARCHAR), customer_zip_code_prefix, customer_state, NULL, 'string' FROM customers
        UNION ALL SELECT 'order_items', CAST(order_id AS VARCHAR), CAST(order_item_id AS VARCHAR), CAST(product_id AS VARCHAR),
            CASE WHEN price > 1000 THEN price END, 'double' FROM items
        UNION ALL SELECT 'best_sellers', CAST(s_suppkey AS VARCHAR), s_name, NULL, CASE WHEN s_acctbal >= 0 THEN s_acctbal END, 'bigint,double,string'
            FROM supplier""",
        "purchases",
        "customers",
        "items",
    ),
)
def load_folder_all(r):
    written = _load(r)
    assert set(written) == {"orders", "customers", "order_items", "best_sellers"}, sorted(written)
    types = {n: dict(t.dtypes) for n, t in written.items()}
    none = F.lit(None)
    shape = {
        "orders": ("order_id", "customer_id", F.col("order_status"), none, types["orders"]["order_purchase_timestamp"]),
        "customers": ("customer_id", "customer_zip_code_prefix", F.col("customer_state"), none, types["customers"]["customer_zip_code_prefix"]),
        "order_items": ("order_id", "order_item_id", F.col("product_id"), F.col("freight"), types["order_items"]["freight"]),
        "best_sellers": ("campaign", "name", none, F.col("spend"), ",".join(types["best_sellers"].values())),
    }
    parts = [
        written[n].select(
            F.lit(n).alias("table_name"),
            F.col(k).cast("string").alias("k"),
            F.col(a).cast("string").alias("a"),
            b.cast("string").alias("b"),
            x.cast("double").alias("x"),
            F.lit(kind).alias("kind"),
        )
        for n, (k, a, b, x, kind) in shape.items()
    ]
    return reduce(DataFrame.union, parts)


@query("empty_typed_table", "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders")
def empty_typed_table(r):
    # A table that starts empty with its declared columns and is filled afterwards.
    path = scratch_path(r.spark, "table")
    filled = r.orders.select("order_id", "customer_id")
    tables.replace_table(tables.empty_table(r.spark, filled.schema), path)
    return tables.append_table(filled, path)


@query("sink_overwrite", "SELECT s_suppkey AS seller_id, s_name AS seller_city FROM supplier")
def sink_overwrite(r):
    path = scratch_path(r.spark, "table")
    sellers = r.sellers.select("seller_id", "seller_city")
    tables.replace_table(sellers.limit(0), path)
    return tables.replace_table(sellers, path)


@query(
    "sink_append",
    """SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def sink_append(r):
    path = scratch_path(r.spark, "table")
    tables.replace_table(r.base("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path)
    return tables.append_table(r.sellers.select(F.col("seller_id").alias("id"), F.col("seller_city").alias("name")), path)


@query("scan_table", "SELECT * FROM customer")
def scan_table(r):
    return tables.scan_parquet(r.spark, f"{r.folder}/customer.parquet")


@query(
    "sink_csv_rfm",
    with_roles(
        """SELECT CAST(customer_unique_id AS VARCHAR) AS customer_unique_id, recency, frequency,
        round(monetary_value, 2) AS monetary_value FROM rfm""",
        "rfm",
    ),
)
def sink_csv_rfm(r):
    path = scratch_path(r.spark, "rfm-csv")
    tables.write_csv(views.rfm(r.orders, r.customers, r.order_items, AS_OF), path)
    schema = "customer_unique_id string, recency double, frequency long, monetary_value double"
    exported = r.spark.read.schema(schema).option("header", True).csv(path)
    return rounded(exported, 2, "monetary_value")


@query("rename_tables", "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders")
def rename_tables(r):
    folder = scratch_path(r.spark, "warehouse")
    name = csv_files.table_name("orders_dataset.csv")
    tables.replace_table(r.orders.select("order_id", "customer_id"), f"{folder}/{name}")
    return tables.scan_parquet(r.spark, f"{folder}/orders")


@query(
    "profile_non_null",
    """SELECT 'order_id' AS column_name, 'bigint' AS data_type, count(o_orderkey) AS non_null FROM orders
    UNION ALL SELECT 'status', 'string', count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) FROM orders
    UNION ALL SELECT 'total', 'double', count(o_totalprice) FROM orders""",
)
def profile_non_null(r):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status")
    orders = r.base("orders").select(F.col("o_orderkey").alias("order_id"), status, F.col("o_totalprice").alias("total"))
    return quality.profile(orders)


# --- Projections, filters, casts ---------------------------------------------------------------


@query(
    "project_orders",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_purchase_timestamp FROM orders",
)
def project_orders(r):
    return r.orders.select("order_id", "customer_id", "order_purchase_timestamp")


@query("drop_column", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_column(r):
    return r.base("customer").drop("c_name")


@query("rename_columns", "SELECT s_suppkey AS seller_id, s_name AS seller_name FROM supplier")
def rename_columns(r):
    kept = r.base("supplier").select("s_suppkey", "s_name")
    return kept.withColumnsRenamed({"s_suppkey": "seller_id", "s_name": "seller_name"})


@query(
    "add_column_if_missing",
    "SELECT p_partkey AS product_id, p_type AS product_category_name, NULL::VARCHAR AS product_category_name_french FROM part",
)
def add_column_if_missing(r):
    products = r.products.select("product_id", "product_category_name")
    once = rows.add_column_if_missing(products, "product_category_name_french", "string")
    return rows.add_column_if_missing(once, "product_category_name_french", "string")


@query(
    "keyed_lookup",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000042'",
)
def keyed_lookup(r):
    found = rows.lookup(r.base("customer"), "c_name", "Customer#000000042")
    return found.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "is_filled",
    """SELECT p_partkey AS product_id, coalesce(p_type <> '' AND translation <> '', FALSE) AS filled
    FROM part LEFT JOIN (SELECT * FROM (VALUES ('economy', 'économique'), ('large', 'grand'), ('medium', 'moyen'),
    ('small', 'petit')) AS d(term, translation)) ON lower(p_type) = term""",
)
def is_filled(r):
    named = translate.translate(
        r.products.withColumn("english", F.lower("product_category_name")), "english", r.dictionary, "french"
    )
    return named.select("product_id", text.is_filled(F.col("english"), F.col("french")).alias("filled"))


@query(
    "geopoint",
    with_roles(
        """SELECT geolocation_zip_code_prefix, n, round(CASE WHEN ok THEN geolocation_lng END, 6) AS x,
        round(CASE WHEN ok THEN geolocation_lat END, 6) AS y
        FROM (SELECT *, coalesce(geolocation_lat <> 0 AND geolocation_lng <> 0, FALSE) AS ok FROM located)""",
        "located",
    ),
)
def geopoint(r):
    points = locations.with_geopoint(_located(r))
    return points.select(
        ZIP, "n", F.round("geopoint_location.x", 6).alias("x"), F.round("geopoint_location.y", 6).alias("y")
    )


@query(
    "cast_timestamps",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS order_approved_at,
    o_orderdate AS order_purchase_timestamp FROM orders""",
)
def cast_timestamps(r):
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    raw = r.base("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(moment).alias("order_approved_at"),
        moment.alias("order_purchase_timestamp"),
    )
    typed = csv_files.cast_to(raw, csv_files.entity_for("orders").schema)
    return typed.withColumn("order_id", F.col("order_id").cast("long"))


@query(
    "cast_rejects",
    """SELECT 'order_approved_at' AS column_name, count(*) AS rejected FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'order_purchase_timestamp', 0""",
)
def cast_rejects(r):
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    raw = r.base("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(moment).alias("order_approved_at"),
        moment.alias("order_purchase_timestamp"),
    )
    return csv_files.cast_rejects(raw, csv_files.entity_for("orders").schema)


@query(
    "cast_varchar_checked",
    """SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS order_id,
    length(CAST(l_orderkey AS VARCHAR)) <= 4 AS fits FROM lineitem""",
)
def cast_varchar_checked(r):
    order_id = F.col("l_orderkey").cast("string")
    fits = ~text.exceeds_length(order_id, 4)
    return r.base("lineitem").select("l_orderkey", "l_linenumber", order_id.alias("order_id"), fits.alias("fits"))


@query(
    "number_to_string",
    """SELECT p_partkey AS product_id, CAST(p_size AS VARCHAR) AS product_name_lenght,
    CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
    ELSE CAST(p_retailprice AS VARCHAR) END AS price FROM part""",
)
def number_to_string(r):
    return r.base("part").select(
        F.col("p_partkey").alias("product_id"),
        text.number_to_string(F.col("p_size").cast("double")).alias("product_name_lenght"),
        text.number_to_string(F.col("p_retailprice")).alias("price"),
    )


@query(
    "recency_days",
    f"""SELECT o_orderkey AS order_id,
    CAST(date_part('day', TIMESTAMP '1999-06-15 13:00:00' - o_orderdate) AS DOUBLE) AS truncated,
    CAST(floor((epoch_us(TIMESTAMP '1999-06-15 13:00:00') - epoch_us(o_orderdate)) / 86400000000.0) AS BIGINT) AS floored
    FROM orders""",
)
def recency_days(r):
    anchor = "1999-06-15 13:00:00"
    return r.orders.select(
        "order_id",
        dates.whole_days_between(F.col("order_purchase_timestamp"), anchor).alias("truncated"),
        dates.floor_days_between(F.col("order_purchase_timestamp"), anchor).alias("floored"),
    )


@query(
    "mercator",
    with_roles(
        """SELECT geolocation_zip_code_prefix, geolocation_city,
        round(6378137.0::DOUBLE * radians(geolocation_lng), 3) AS mercator_x,
        round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(geolocation_lat) / 2)
            * pow((1 - 0.0818191908426::DOUBLE * sin(radians(geolocation_lat)))
                / (1 + 0.0818191908426::DOUBLE * sin(radians(geolocation_lat))), 0.0818191908426::DOUBLE / 2)), 3) AS mercator_y,
        round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(geolocation_lat) / 2)), 3) AS spherical_y FROM geolocation""",
        "geolocation",
    ),
)
def mercator(r):
    return r.geolocation.select(
        ZIP,
        "geolocation_city",
        F.round(mercator_x(F.col(LNG)), 3).alias("mercator_x"),
        F.round(mercator_y(F.col(LAT)), 3).alias("mercator_y"),
        F.round(mercator_y(F.col(LAT), spherical=True), 3).alias("spherical_y"),
    )


# --- Joins -------------------------------------------------------------------------------------


@query(
    "join_inner",
    with_roles(
        "SELECT order_id, customer_id, customer_city FROM purchases JOIN customers USING (customer_id)",
        "purchases",
        "customers",
    ),
)
def join_inner(r):
    joined = r.orders.join(r.customers, "customer_id")
    return joined.select("order_id", "customer_id", "customer_city")


@query(
    "join_left",
    """SELECT o_orderkey AS order_id, CAST(l_linenumber AS DOUBLE) AS order_item_id, l_extendedprice AS price
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_left(r):
    orders, items = r.orders, r.order_items.withColumnRenamed("order_id", "item_order_id")
    joined = orders.join(items, F.col("order_id") == F.col("item_order_id"), "left")
    return joined.select("order_id", F.col("order_item_id").cast("double").alias("order_item_id"), "price")


@query(
    "join_left_using",
    with_roles(
        """SELECT order_id, customer_id, order_purchase_timestamp, CAST(total_items_sold AS DOUBLE) AS total_items_sold,
        round(total_price, 2) AS total_price FROM purchases LEFT JOIN order_totals USING (order_id)""",
        "purchases",
        "order_totals",
    ),
)
def join_left_using(r):
    orders = r.orders.select("order_id", "customer_id", "order_purchase_timestamp")
    return _nullable_count(rounded(orders.join(views.items_by_order(r.order_items), "order_id", "left"), 2, "total_price"))


@query(
    "join_anti",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def join_anti(r):
    return joins.without_match(r.orders.select("order_id", "customer_id"), r.order_items, "order_id")


@query(
    "join_null_safe",
    """SELECT term, n_orders, n_products FROM (
        SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS term, count(*) AS n_orders FROM orders GROUP BY 1) a
    JOIN (SELECT CASE WHEN l_returnflag <> 'N' THEN CASE l_returnflag WHEN 'A' THEN 'F' ELSE 'O' END END AS key,
        count(*) AS n_products FROM lineitem GROUP BY 1) b ON term IS NOT DISTINCT FROM key""",
)
def join_null_safe(r):
    status = F.when(F.col("order_status") != "P", F.col("order_status")).alias("term")
    orders = r.orders.groupBy(status).agg(F.count(F.lit(1)).alias("n_orders"))
    flag = F.col("l_returnflag")
    kind = F.when(flag != "N", F.when(flag == "A", "F").otherwise("O")).alias("term")
    lines = r.base("lineitem").groupBy(kind).agg(F.count(F.lit(1)).alias("n_products"))
    return joins.merge(orders, lines, "term")


@query(
    "seller_locations",
    with_roles(
        """SELECT DISTINCT seller_zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat,
        round(geolocation_lng, 6) AS geolocation_lng
        FROM sellers JOIN located ON seller_zip_code_prefix = geolocation_zip_code_prefix""",
        "sellers",
        "located",
    ),
)
def seller_locations(r):
    return rounded(locations.seller_locations(r.sellers, _located(r)), 6, LAT, LNG)


@query(
    "customer_geo_bridge",
    with_roles(
        """SELECT customer_id, customer_zip_code_prefix, geolocation_lat, geolocation_lng, CAST(copy AS VARCHAR) AS copy FROM customers
        JOIN (SELECT DISTINCT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng FROM geolocation)
        ON customer_zip_code_prefix = geolocation_zip_code_prefix, (VALUES (1), (2)) AS v(copy)""",
        "customers",
        "geolocation",
    ),
)
def customer_geo_bridge(r):
    # Every point of a zip twice: a bounded number of points, whatever the number of customers.
    once = r.geolocation.select(ZIP, LAT, LNG).distinct()
    points = joins.with_point_ids(once.union(once))
    bridge = joins.zip_bridge(r.customers, points).join(points, "geolocation_id")
    copy = F.split_part("geolocation_id", F.lit("-"), F.lit(2)).alias("copy")
    return bridge.select("customer_id", "customer_zip_code_prefix", LAT, LNG, copy)


@query(
    "translate_lookup",
    with_roles(
        """SELECT product_id, product_category_name, translation AS product_category_name_french
        FROM products LEFT JOIN dictionary ON lower(product_category_name) = term""",
        "products",
        "dictionary",
    ),
)
def translate_lookup(r):
    products = r.products.select("product_id", "product_category_name", F.lower("product_category_name").alias("english"))
    return translate.translate(products, "english", r.dictionary, "product_category_name_french").drop("english")


@query(
    "translate_missing",
    with_roles(
        """SELECT DISTINCT lower(product_category_name) AS term FROM products
        WHERE lower(product_category_name) NOT IN (SELECT term FROM dictionary)""",
        "products",
        "dictionary",
    ),
)
def translate_missing(r):
    products = r.products.select(F.lower("product_category_name").alias("english"))
    return translate.untranslated(products, "english", r.dictionary)


# --- Aggregates, windows, order ----------------------------------------------------------------


@query(
    "distinct_keys",
    with_roles("SELECT DISTINCT customer_zip_code_prefix FROM customers", "customers"),
)
def distinct_keys(r):
    return r.customers.select("customer_zip_code_prefix").distinct()


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(r):
    return r.base("orders").select("o_orderpriority").distinct()


@query(
    "column_cardinality",
    with_roles(
        """SELECT count(DISTINCT recency) AS recency, count(DISTINCT frequency) AS frequency,
        count(DISTINCT round(monetary_value, 2)) AS monetary_value FROM rfm""",
        "rfm",
    ),
)
def column_cardinality(r):
    table = rounded(_rfm(r), 2, "monetary_value")
    return table.agg(*[F.count_distinct(c).alias(c) for c in RFM])


@query(
    "distinct_sketches",
    """SELECT o_orderstatus AS order_status, count(DISTINCT o_custkey) AS customers, TRUE AS within FROM orders GROUP BY 1
    UNION ALL SELECT 'all', count(DISTINCT o_custkey), TRUE FROM orders""",
)
def distinct_sketches(r):
    # Sketches by status, merged to one of all orders, next to the exact counts.
    parts = materialise(distinct.distinct_sketches(r.orders, ["order_status"], ["customer_id"]), "sketches")
    everything = distinct.merge_sketches(parts.withColumn("order_status", F.lit("all")), ["order_status"], ["customer_id"])
    found = distinct.estimates(parts.unionByName(everything), ["customer_id"])
    orders = r.orders.withColumn("order_status", F.explode(F.array("order_status", F.lit("all"))))
    exact = orders.groupBy("order_status").agg(F.count_distinct("customer_id").alias("customers"))
    close = F.abs(F.col("customer_id") - F.col("customers")) <= F.col("customers") * distinct.relative_error()
    return exact.join(found, "order_status").select("order_status", "customers", close.alias("within"))


@query(
    "quantile_approximate",
    with_roles(" UNION ALL ".join(f"SELECT '{c}' AS column_name, i AS place, count({c}) AS n, TRUE AS within FROM rfm, range(5) AS t(i) GROUP BY i" for c in RFM), "rfm"),
)
def quantile_approximate(r):
    # The rank of every value found lies within the stated error of the wanted one.
    table, error, asked = materialise(_rfm(r), "rfm"), 0.01, [0.1, 0.25, 0.5, 0.75, 0.9]
    found = quantiles.approximate_quantiles(table, RFM, asked, error)
    long = table.select(*[F.col(c).cast("double") for c in RFM]).unpivot([], RFM, "c", "x").where("x IS NOT NULL")
    share = F.element_at(F.array(*[F.lit(a) for a in asked]), F.col("p").cast("int") + 1)
    counts = long.join(found, "c").groupBy("c", "p").agg(
        F.count("*").alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto")
    )
    slack = F.col("n") * error + 1
    close = (F.col("below") <= F.col("n") * share + slack) & (F.col("upto") >= F.col("n") * share - slack)
    return counts.select(F.col("c").alias("column_name"), F.col("p").cast("long").alias("place"), "n", close.alias("within"))


@query(
    "quantile_edges",
    with_roles(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST(i AS INTEGER) AS edge_no,
            round(quantile_cont(CAST({c} AS DOUBLE), [0, 0.2, 0.4, 0.6, 0.8, 1])[i + 1], 4) AS edge
            FROM rfm, range(6) AS t(i) GROUP BY i"""
            for c in RFM
        ),
        "rfm",
    ),
)
def quantile_edges(r):
    return rounded(segments.edges_table(materialise(_rfm(r), "rfm"), RFM), 4, "edge")


@query(
    "row_number_dups",
    """SELECT l_orderkey, l_linenumber, max(rn) AS n_rows FROM (
        SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey) AS rn
        FROM lineitem) GROUP BY 1, 2 HAVING max(rn) > 1""",
)
def row_number_dups(r):
    return rows.duplicate_keys(r.base("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "sort_desc",
    """SELECT CAST(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS DOUBLE) AS id, o_custkey, o_totalprice FROM orders
    ORDER BY id DESC NULLS FIRST""",
)
def sort_desc(r):
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).cast("double").alias("id")
    return rows.sort_descending(r.base("orders").select(key, "o_custkey", "o_totalprice"), "id")


@query("limit_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 15")
def limit_preview(r):
    return r.base("customer").orderBy("c_custkey").limit(15)


@query(
    "geo_preview_mercator",
    with_roles(
        """SELECT geolocation_zip_code_prefix, round(6378137.0::DOUBLE * radians(geolocation_lng), 3) AS mercator_x,
        round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(geolocation_lat) / 2)
            * pow((1 - 0.0818191908426::DOUBLE * sin(radians(geolocation_lat)))
                / (1 + 0.0818191908426::DOUBLE * sin(radians(geolocation_lat))), 0.0818191908426::DOUBLE / 2)), 3) AS mercator_y
        FROM (SELECT * FROM located ORDER BY geolocation_zip_code_prefix LIMIT 1000)""",
        "located",
    ),
)
def geo_preview_mercator(r):
    preview = locations.projected(_located(r).orderBy(ZIP).limit(1000))
    return rounded(preview.select(ZIP, "mercator_x", "mercator_y"), 3, "mercator_x", "mercator_y")


# --- Cleaning and table changes ----------------------------------------------------------------


@query("delete_dup_single_key", with_roles("SELECT * FROM clean_reviews", "clean_reviews"))
def delete_dup_single_key(r):
    return _clean_reviews(r)


@query(
    "delete_dup_multi_key",
    """SELECT * FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag) = 1""",
)
def delete_dup_multi_key(r):
    return rows.delete_duplicates(r.base("lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag"])


@query(
    "keep_first_of_key",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def keep_first_of_key(r):
    lines = r.base("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return rows.delete_duplicates(lines, ["l_orderkey", "l_linenumber"], keep="first", order_by=order)


@query(
    "geo_centroid",
    with_roles(
        """SELECT geolocation_zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat,
        round(geolocation_lng, 6) AS geolocation_lng, geolocation_city, geolocation_state, n FROM centroids""",
        "centroids",
    ),
)
def geo_centroid(r):
    return rounded(_centroids(r), 6, LAT, LNG)


@query(
    "geo_gap_fill_customers",
    with_roles(
        """SELECT geolocation_zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat,
        round(geolocation_lng, 6) AS geolocation_lng, geolocation_city, geolocation_state, n FROM customer_filled""",
        "customer_filled",
    ),
)
def geo_gap_fill_customers(r):
    return rounded(locations.fill_customer_zips(_centroids(r), r.customers), 6, LAT, LNG)


@query(
    "geo_upsert_sellers",
    with_roles(
        """SELECT geolocation_zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat,
        round(geolocation_lng, 6) AS geolocation_lng, geolocation_city, geolocation_state, n FROM located""",
        "located",
    ),
)
def geo_upsert_sellers(r):
    return rounded(_located(r), 6, LAT, LNG)


@query(
    "update_by_key",
    """SELECT c_custkey, c_name, coalesce(first_status, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (
        SELECT o_custkey, min(o_orderpriority) AS first_status FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def update_by_key(r):
    changes = r.base("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("c_mktsegment"))
    customers = r.base("customer").select("c_custkey", "c_name", "c_mktsegment")
    return rows.update_column(customers, changes, "c_custkey", "c_mktsegment")


@query(
    "dimension_append",
    with_roles(
        """SELECT * FROM translation UNION ALL SELECT term, translation FROM dictionary
        WHERE term NOT IN (SELECT product_category_name FROM translation)""",
        "translation",
        "dictionary",
    ),
)
def dimension_append(r):
    new = r.dictionary.toDF("product_category_name", "product_category_name_english")
    return rows.append_rows(r.translation, new, ["product_category_name"])


@query("snapshot_upsert_sellers", ORACLES["geo_upsert_sellers"])
def snapshot_upsert_sellers(r):
    # The same centroid table, changed in place: only partitions that hold new zips are written again.
    path = scratch_path(r.spark, "snapshot")
    snapshots.overwrite(_centroids(r), path, [ZIP])
    snapshots.append_missing(path, r.customers.select("customer_zip_code_prefix"), n=0)
    missing = rows.missing_rows(snapshots.read(r.spark, path), ZIP, r.sellers.select("seller_zip_code_prefix"), n=0)
    snapshots.upsert(path, missing)
    return rounded(snapshots.read(r.spark, path), 6, LAT, LNG)


@query("snapshot_update", ORACLES["update_by_key"])
def snapshot_update(r):
    path = scratch_path(r.spark, "snapshot")
    snapshots.overwrite(r.base("customer").select("c_custkey", "c_name", "c_mktsegment"), path, ["c_custkey"])
    changes = r.base("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("c_mktsegment"))
    snapshots.update_column(path, changes, "c_mktsegment")
    return snapshots.read(r.spark, path)


@query(
    "snapshot_delete_append",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'""",
)
def snapshot_delete_append(r):
    path = scratch_path(r.spark, "snapshot")
    orders = r.base("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    snapshots.overwrite(orders, path, ["o_orderkey"])
    snapshots.delete(path, orders.where("o_orderstatus = 'F'").select("o_orderkey"))
    snapshots.append(path, orders.where("o_orderstatus = 'O'").withColumn("o_orderkey", -F.col("o_orderkey")))
    return snapshots.read(r.spark, path)


# --- Data quality ------------------------------------------------------------------------------


@query(
    "pk_violations",
    """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, count(*) AS n_rows FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def pk_violations(r):
    return quality.primary_key_violations(r.order_items, ["order_id", "order_item_id"])


@query(
    "fk_violations",
    with_roles(
        """SELECT customer_zip_code_prefix, count(*) AS n_rows FROM customers WHERE customer_zip_code_prefix NOT IN (
        SELECT geolocation_zip_code_prefix FROM centroids) GROUP BY 1""",
        "customers",
        "centroids",
    ),
)
def fk_violations(r):
    return quality.foreign_key_violations(r.customers, "customer_zip_code_prefix", _centroids(r), ZIP)


@query(
    "length_violations",
    """SELECT 'customer_city' AS column_name, 8 AS max_length, count(*) FILTER (length(c_mktsegment) > 8) AS violations
    FROM customer UNION ALL SELECT 'customer_state', 1,
    count(*) FILTER (length(lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) > 1) FROM customer""",
)
def length_violations(r):
    return quality.length_violations(r.customers, {"customer_city": 8, "customer_state": 1})


# Declared table -> the expression that holds it in SQL.
_CHECKED = {
    "customers": "customers",
    "orders": "purchases",
    "order_items": "items",
    "order_payments": "payments",
    "order_reviews": "reviews",
    "products": "described",
    "sellers": "sellers",
    "geolocation": "geolocation",
    "geolocation_bis": "located",
    "brazil_states": "states",
    "product_category_name_translation": "translation",
}
_DESCRIBED = """SELECT *, p_brand || repeat('x', 10 * p_size) AS product_description_lenght, CAST(p_size AS VARCHAR) AS product_photos_qty
    FROM products JOIN part ON product_id = p_partkey"""


def _check_sql() -> str:
    """Every declared key, reference and length as one row."""
    parts = []
    for name, source in _CHECKED.items():
        entity = ENTITIES[name]
        keys = list(entity.primary_key)
        if keys:
            part = " OR ".join(f"{k} IS NULL" for k in keys)
            found = f"SELECT 1 FROM {source} GROUP BY {', '.join(keys)} HAVING count(*) > 1 OR {part}"
            parts.append(f"SELECT '{name}' AS table_name, 'primary key' AS \"check\", '{', '.join(keys)}' AS columns, (SELECT count(*) FROM ({found})) AS violations")
        for column, parent, other in entity.foreign_keys:
            found = f"SELECT 1 FROM {source} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {other} FROM {_CHECKED[parent]})"
            parts.append(f"SELECT '{name}', 'foreign key', '{column} -> {parent}', (SELECT count(*) FROM ({found}))")
        for column, most in entity.lengths.items():
            found = f"SELECT 1 FROM {source} WHERE length(rtrim(CAST({column} AS VARCHAR))) > {most}"
            parts.append(f"SELECT '{name}', 'length', '{column} <= {most}', (SELECT count(*) FROM ({found}))")
    return " UNION ALL ".join(parts)


@query("check_tables", with_roles(_check_sql(), *[r for r in _CHECKED.values() if r != "described"], "products", described=_DESCRIBED))
def check_tables(r):
    part = r.base("part")
    described = F.concat("p_brand", F.repeat(F.lit("x"), F.col("p_size") * 10))
    products = r.products.join(part, F.col("product_id") == F.col("p_partkey")).select(
        "product_id",
        "product_category_name",
        "product_name_lenght",
        described.alias("product_description_lenght"),
        F.col("p_size").cast("string").alias("product_photos_qty"),
    )
    names = [n for n in _CHECKED if n not in ("products", "geolocation_bis", "product_category_name_translation")]
    found = {n: getattr(r, n) for n in names} | {"products": products}
    found |= {"geolocation_bis": materialise(_located(r), "located"), "product_category_name_translation": r.translation}
    typed = {}
    for name, df in found.items():
        texts = set(ENTITIES[name].lengths) | {c for c, *_ in ENTITIES[name].foreign_keys} | set(ENTITIES[name].primary_key)
        typed[name] = df.withColumns({c: F.col(c).cast("string") for c in texts & set(df.columns)})
    return quality.check_tables(typed)


# --- Views -------------------------------------------------------------------------------------

_PLACE = "customer_zip_code_prefix, customer_city, customer_state, region"


@query(
    "payments_orders",
    with_roles(
        "SELECT order_id, payment_value, customer_id, order_purchase_timestamp FROM payments JOIN purchases USING (order_id)",
        "payments",
        "purchases",
    ),
)
def payments_orders(r):
    return views.payments_orders(r.order_payments, r.orders)


@query(
    "customers_region_inner",
    with_roles(
        f"SELECT customer_id, {_PLACE} FROM customers JOIN states ON customer_state = abbreviation", "customers", "states"
    ),
)
def customers_region_inner(r):
    return views.customers_region_inner(r.customers, r.brazil_states)


@query("customers_region_left", with_roles("SELECT * FROM placed", "placed"))
def customers_region_left(r):
    return views.customers_region_left(r.customers, r.brazil_states)


@query(
    "payments_orders_customers",
    with_roles(
        f"""SELECT order_id, payment_value, customer_id, order_purchase_timestamp, {_PLACE}
        FROM payments JOIN purchases USING (order_id) JOIN placed USING (customer_id)""",
        "payments",
        "purchases",
        "placed",
    ),
)
def payments_orders_customers(r):
    return views.payments_orders_customers(r.order_payments, r.orders, r.customers, r.brazil_states)


@query(
    "payments_orders_customers_items",
    with_roles(
        f"""SELECT order_id, payment_value, customer_id, order_purchase_timestamp, {_PLACE}, product_id, seller_id, price
        FROM payments JOIN purchases USING (order_id) JOIN placed USING (customer_id) JOIN items USING (order_id)""",
        "payments",
        "purchases",
        "placed",
        "items",
    ),
)
def payments_orders_customers_items(r):
    return views.payments_orders_customers_items(r.order_payments, r.orders, r.customers, r.brazil_states, r.order_items)


@query(
    "payments_orders_customers_items_products",
    with_roles(
        f"""SELECT order_id, customer_id, order_purchase_timestamp, payment_value, price, product_category_name, product_id,
        {_PLACE}, seller_id FROM payments JOIN purchases USING (order_id) JOIN placed USING (customer_id)
        JOIN items USING (order_id) JOIN products USING (product_id)""",
        "payments",
        "purchases",
        "placed",
        "items",
        "products",
    ),
)
def payments_orders_customers_items_products(r):
    return views.payments_orders_customers_items_products(
        r.order_payments, r.orders, r.customers, r.brazil_states, r.order_items, r.products
    )


@query(
    "order_infos",
    with_roles(
        """SELECT customer_id, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
        order_delivered_customer_date, order_estimated_delivery_date, customer_zip_code_prefix,
        round(a.geolocation_lat, 6) AS customer_lat, round(a.geolocation_lng, 6) AS customer_lng, seller_id,
        seller_zip_code_prefix, round(b.geolocation_lat, 6) AS seller_lat, round(b.geolocation_lng, 6) AS seller_lng,
        review_id, review_creation_date
        FROM purchases JOIN items USING (order_id) JOIN clean_reviews USING (order_id) JOIN sellers USING (seller_id)
        JOIN customers USING (customer_id)
        JOIN located a ON customer_zip_code_prefix = a.geolocation_zip_code_prefix
        JOIN located b ON seller_zip_code_prefix = b.geolocation_zip_code_prefix""",
        "purchases",
        "items",
        "clean_reviews",
        "sellers",
        "customers",
        "located",
    ),
)
def order_infos(r):
    # The centroid table is a stored one: it is used in two roles.
    located = rounded(materialise(_located(r), "located"), 6, LAT, LNG)
    return views.order_infos(r.orders, r.order_items, _clean_reviews(r), r.sellers, r.customers, located)


def _hot(sizes: dict[str, DataFrame]):
    """A join for views that spreads hot keys; the first side's keys are those of the facts it was made from."""
    return lambda left, right, key: hot_join(left, right, key, left_keys=sizes[key], right_keys=None)


@query("order_infos_hot_keys", ORACLES["order_infos"])
def order_infos_hot_keys(r):
    located = rounded(materialise(_located(r), "located"), 6, LAT, LNG)
    join = _hot({"order_id": r.order_items})
    return views.order_infos(r.orders, r.order_items, _clean_reviews(r), r.sellers, r.customers, located, join)


@query("payments_orders_customers_items_hot_keys", ORACLES["payments_orders_customers_items"])
def payments_orders_customers_items_hot_keys(r):
    join = _hot({"order_id": r.order_payments})
    return views.payments_orders_customers_items(r.order_payments, r.orders, r.customers, r.brazil_states, r.order_items, join)


@query(
    "frequent_keys",
    """SELECT l_suppkey AS seller_id, count(*) AS n_rows FROM lineitem GROUP BY 1
    HAVING count(*) >= 0.005 * (SELECT count(*) FROM lineitem)""",
)
def frequent_keys_exactly(r):
    # The sketch names the candidates; their rows are counted.
    share = 0.005
    items = r.order_items.select("seller_id")
    candidates = frequent_keys(items, "seller_id", share).select("seller_id")
    counts = items.join(F.broadcast(candidates), "seller_id", "left_semi").groupBy("seller_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") >= items.count() * share)


@query("orders_customers", with_roles("SELECT * FROM placed_orders", "placed_orders"))
def orders_customers(r):
    return views.orders_customers(r.orders, r.customers, r.brazil_states)


@query(
    "payments_by_order",
    with_roles(
        "SELECT order_id, round(sum(payment_value), 4) AS total_payment_value FROM payments GROUP BY 1", "payments"
    ),
)
def payments_by_order(r):
    return rounded(views.payments_by_order(r.order_payments), 4, "total_payment_value")


@query(
    "orders_customers_payments",
    with_roles(
        f"""SELECT order_id, customer_id, order_purchase_timestamp, {_PLACE},
        round(total_payment_value, 4) AS total_payment_value FROM placed_orders
        LEFT JOIN (SELECT order_id, sum(payment_value) AS total_payment_value FROM payments GROUP BY 1) USING (order_id)""",
        "placed_orders",
        "payments",
    ),
)
def orders_customers_payments(r):
    view = views.orders_customers_payments(r.orders, r.customers, r.brazil_states, r.order_payments)
    return rounded(view, 4, "total_payment_value")


@query(
    "items_by_order",
    with_roles("SELECT order_id, total_items_sold, round(total_price, 2) AS total_price FROM order_totals", "order_totals"),
)
def items_by_order(r):
    return rounded(views.items_by_order(r.order_items), 2, "total_price")


@query(
    "orders_customers_items",
    with_roles(
        """SELECT * REPLACE (CAST(total_items_sold AS DOUBLE) AS total_items_sold, round(total_price, 2) AS total_price)
        FROM person_orders""",
        "person_orders",
    ),
)
def orders_customers_items(r):
    view = views.orders_customers_items(r.orders, r.customers, r.brazil_states, r.order_items)
    return _nullable_count(rounded(view, 2, "total_price"))


_MONTHS = """SELECT CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS purchase_month, customer_state,
    customer_unique_id, count(customer_unique_id) AS nb_purchases FROM placed_orders GROUP BY 1, 2, 3"""


@query(
    "new_customers_month", with_roles(f"{_MONTHS} HAVING count(customer_unique_id) = 1", "placed_orders")
)
def new_customers_month(r):
    return views.new_customers_month(r.orders, r.customers)


@query("repurchases_month", with_roles(f"{_MONTHS} HAVING count(customer_unique_id) > 1", "placed_orders"))
def repurchases_month(r):
    return views.repurchases_month(r.orders, r.customers)


@query(
    "customer_margin",
    with_roles(
        """SELECT customer_unique_id, round(0.03::DOUBLE * sum(total_price), 4) AS margin FROM person_orders
        GROUP BY customer_unique_id""",
        "person_orders",
    ),
)
def customer_margin(r):
    return rounded(views.customer_margin(r.orders, r.customers, r.order_items), 4, "margin")


@query(
    "avg_margin",
    with_roles(
        """SELECT round(avg(margin), 4) AS avg_margin FROM (SELECT 0.03::DOUBLE * sum(total_price) AS margin
        FROM person_orders GROUP BY customer_unique_id)""",
        "person_orders",
    ),
)
def avg_margin(r):
    return rounded(views.avg_margin(r.orders, r.customers, r.order_items), 4, "avg_margin")


@query(
    "last_frequency_monetary",
    with_roles(
        """SELECT customer_unique_id, max(order_purchase_timestamp) AS last_purchase, count(order_id) AS frequency,
        round(sum(total_price), 2) AS monetary_value FROM person_orders GROUP BY customer_unique_id""",
        "person_orders",
    ),
)
def last_frequency_monetary(r):
    return rounded(views.last_frequency_monetary(r.orders, r.customers, r.order_items), 2, "monetary_value")


def _loads(r: Roles):
    """Orders as they come in, in three loads by date; the last is handed in twice."""
    cuts = ["1900-01-01", "1996-01-01", "2000-01-01", "2100-01-01"]
    for load in (1, 2, 3, 3):
        low, high = (F.lit(c).cast("timestamp_ntz") for c in cuts[load - 1 : load + 1])
        yield load, r.orders.where((F.col("order_purchase_timestamp") >= low) & (F.col("order_purchase_timestamp") < high))


@query("refreshed_persons", ORACLES["last_frequency_monetary"])
def refreshed_persons(r):
    path = scratch_path(r.spark, "state")
    for load, orders in _loads(r):
        items = r.order_items.join(orders.select("order_id"), "order_id", "left_semi")
        refresh.load_persons(path, orders, r.customers, items, load)
    return rounded(refresh.last_frequency_monetary(r.spark, path), 2, "monetary_value")


@query("refreshed_new_customers_month", ORACLES["new_customers_month"])
def refreshed_new_customers_month(r):
    path = scratch_path(r.spark, "state")
    for load, orders in _loads(r):
        refresh.load_months(path, orders, r.customers, load)
    return refresh.new_customers_month(r.spark, path)


@query("refreshed_repurchases_month", ORACLES["repurchases_month"])
def refreshed_repurchases_month(r):
    path = scratch_path(r.spark, "state")
    for load, orders in _loads(r):
        refresh.load_months(path, orders, r.customers, load)
    return refresh.repurchases_month(r.spark, path)


@query("rfm", with_roles("SELECT * REPLACE (round(monetary_value, 2) AS monetary_value) FROM rfm", "rfm"))
def rfm(r):
    return rounded(_rfm(r), 2, "monetary_value")


@query(
    "rfm_payments",
    with_roles(
        f"""SELECT customer_unique_id,
        CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(order_purchase_timestamp))) / 86400000000.0) AS BIGINT) AS recency,
        count(DISTINCT order_id) AS frequency, round(sum(payment_value), 4) AS monetary_value
        FROM purchases JOIN payments USING (order_id) JOIN customers USING (customer_id) GROUP BY customer_unique_id""",
        "purchases",
        "payments",
        "customers",
    ),
)
def rfm_payments(r):
    return rounded(views.rfm_payments(r.orders, r.order_payments, r.customers, AS_OF), 4, "monetary_value")


@query("named_views", " UNION ALL ".join(f"SELECT '{v}' AS view_name, count(*) AS n_rows FROM ({ORACLES[v]})" for v in views.VIEWS))
def named_views(r):
    stored = {n: getattr(r, n) for n in ("orders", "customers", "brazil_states", "order_items", "order_payments")}
    stored |= {"order_reviews": _clean_reviews(r), "products": r.products, "sellers": r.sellers, "geolocation_bis": materialise(_located(r), "located")}
    prefix = "cartwise_testbed_"  # the caller's own views stay as they are
    names = views.register_views(stored, prefix)
    counts = [f"SELECT '{n}' AS view_name, count(*) AS n_rows FROM {prefix}{n}" for n in names]
    return r.spark.sql(" UNION ALL ".join(counts))


# --- Scores, imputation, clustering ------------------------------------------------------------

_SCORED = """SELECT customer_unique_id, recency, frequency, monetary_value, {} FROM rfm, (SELECT {} FROM rfm)"""


def _score_sql() -> str:
    """R, F and M as one plus the distinct interior edges strictly below the value."""
    scores, edges = [], []
    for label, c in segments.SCORES.items():
        edges.append(f"quantile_cont(CAST({c} AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS {label}_e, min({c}) AS {label}_min")
        scores.append(
            f"CAST(1 + len(list_distinct([e FOR e IN {label}_e IF e < {c} AND e > {label}_min])) AS INTEGER) AS {label}"
        )
    return _SCORED.format(", ".join(scores), ", ".join(edges))


@query(
    "rfm_scores",
    with_roles(
        "SELECT * REPLACE (round(monetary_value, 2) AS monetary_value) FROM scored", "rfm", scored=_score_sql()
    ),
)
def rfm_scores(r):
    return rounded(_scored(r), 2, "monetary_value")


@query(
    "rfm_segment_counts",
    with_roles(
        'SELECT R, F, M, count(*) AS "count", concat(R, F, M) AS segment FROM scored GROUP BY R, F, M',
        "rfm",
        scored=_score_sql(),
    ),
)
def rfm_segment_counts(r):
    return segments.segment_counts(_scored(r))


@query(
    "cluster_median",
    with_roles(
        """SELECT R, round(median(recency), 4) AS recency, round(median(frequency), 4) AS frequency,
        round(median(monetary_value), 4) AS monetary_value FROM scored GROUP BY R""",
        "rfm",
        scored=_score_sql(),
    ),
)
def cluster_median(r):
    return rounded(segments.median_by_group(materialise(_scored(r), "scored"), "R", RFM), 4, *RFM)


@query(
    "median_by_many_groups",
    """SELECT l_partkey, round(median(l_extendedprice), 4) AS l_extendedprice, round(median(l_quantity), 4) AS l_quantity
    FROM lineitem GROUP BY l_partkey""",
)
def median_by_many_groups(r):
    priced = ["l_extendedprice", "l_quantity"]
    return rounded(segments.median_by_group(r.base("lineitem"), "l_partkey", priced), 4, *priced)


@query(
    "knn_impute",
    with_roles(
        """, receivers AS (SELECT * FROM gappy_rfm WHERE monetary_value IS NULL),
        donors AS (SELECT * FROM gappy_rfm WHERE monetary_value IS NOT NULL),
        near AS (SELECT a.customer_unique_id, b.monetary_value FROM receivers a, donors b
            QUALIFY row_number() OVER (PARTITION BY a.customer_unique_id ORDER BY
                (a.recency - b.recency) ** 2 + (a.frequency - b.frequency) ** 2, b.customer_unique_id) <= 2)
        SELECT customer_unique_id, recency, frequency, round(monetary_value, 4) AS monetary_value, FALSE AS imputed FROM donors
        UNION ALL SELECT customer_unique_id, recency, frequency, round(m, 4), TRUE FROM receivers
        JOIN (SELECT customer_unique_id, avg(monetary_value) AS m FROM near GROUP BY 1) USING (customer_unique_id)""",
        "gappy_rfm",
    ),
)
def knn_impute_query(r):
    table = materialise(_gappy_rfm(r), "gappy-rfm")
    filled = knn_impute(table.withColumn("imputed", F.col("monetary_value").isNull()), PERSON, RFM)
    return rounded(filled, 4, "monetary_value")


_ROUND_SCALED = "SELECT customer_unique_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in RFM) + " FROM scaled"


@query("standard_scale", with_roles(_ROUND_SCALED, "scaled"))
def standard_scale(r):
    return rounded(_scaled(r), 6, *RFM)


@query(
    "inertia_k1",
    with_roles(
        "SELECT round(" + " + ".join(f"var_pop({c}) * count({c})" for c in RFM) + ", 4) AS inertia FROM scaled", "scaled"
    ),
)
def inertia_k1(r):
    return rounded(scaling.inertia_of_one(_scaled(r), RFM), 4, "inertia")


def _labelled_sql() -> dict[str, str]:
    return {
        "scored": _score_sql(),
        "points": "SELECT s.customer_unique_id, R, " + ", ".join(f"s.{c}" for c in RFM) + " FROM scaled s JOIN scored USING (customer_unique_id)",
    }


def _silhouette_sql(distance: str) -> str:
    return f""", means AS (SELECT a.customer_unique_id, a.R, b.R AS other, count(*) AS n, sum({distance}) AS total
            FROM points a, points b GROUP BY ALL),
        sides AS (SELECT customer_unique_id, max(CASE WHEN R = other THEN n END) AS n,
            max(CASE WHEN R = other AND n > 1 THEN total / (n - 1) END) AS a,
            min(CASE WHEN R <> other THEN total / n END) AS b FROM means GROUP BY 1)"""


_SQUARES = " + ".join(f"(a.{c} - b.{c}) ** 2" for c in RFM)
_SCORE = "avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END)"


@query(
    "silhouette_squared",
    with_roles(
        f"{_silhouette_sql(_SQUARES)} SELECT count(*) AS n, round({_SCORE}, 6) AS silhouette FROM sides",
        "scaled",
        **_labelled_sql(),
    ),
)
def silhouette_squared(r):
    return rounded(silhouette.silhouette_squared(_labelled(r), RFM, "R"), 6, "silhouette")


@query(
    "silhouette_euclidean",
    with_roles(
        f"""{_silhouette_sql(f"sqrt({_SQUARES})")} SELECT count(*) AS n, round({_SCORE}, 6) AS silhouette,
        round({_SCORE}, 6) AS lower, round({_SCORE}, 6) AS upper FROM sides""",
        "scaled",
        **_labelled_sql(),
    ),
)
def silhouette_euclidean(r):
    return rounded(silhouette.silhouette_euclidean(_labelled(r), RFM, "R"), 6, "silhouette", "lower", "upper")


@query("silhouette_within", with_roles("SELECT count(*) AS n, TRUE AS narrow, TRUE AS encloses FROM points", "scaled", **_labelled_sql()))
def silhouette_within(r):
    # By the trees of the clusters, next to the exact score.
    table = materialise(_labelled(r), "labelled")
    exact = silhouette.silhouette_euclidean(table, RFM, "R").select("n", F.col("silhouette").alias("exact"))
    found = silhouette.silhouette_euclidean(table, RFM, "R", tolerance=0.01).join(exact, "n")
    return found.select("n", (F.col("upper") - F.col("lower") <= 0.01).alias("narrow"), F.col("exact").between(F.col("lower"), F.col("upper")).alias("encloses"))


@query(
    "kmeans_predict",
    with_roles(
        """, centers AS (SELECT R, """
        + ", ".join(f"avg({c}) AS {c}" for c in RFM)
        + """ FROM points GROUP BY R),
        numbered AS (SELECT *, row_number() OVER (ORDER BY recency, frequency, monetary_value) - 1 AS number FROM centers)
        SELECT customer_unique_id, CAST(number AS INTEGER) AS cluster FROM (
            SELECT a.customer_unique_id, b.number, row_number() OVER (
                PARTITION BY a.customer_unique_id ORDER BY """
        + " + ".join(f"(a.{c} - b.{c}) ** 2" for c in RFM)
        + """, b.number) AS place FROM points a, numbered b) WHERE place = 1""",
        "scaled",
        **_labelled_sql(),
    ),
)
def kmeans_predict(r):
    # The centres of the five recency groups stand in for a fitted model.
    labelled = _labelled(r)
    means = labelled.groupBy("R").agg(*[F.avg(c).alias(c) for c in RFM]).collect()  # five rows
    centers = sorted(tuple(m[c] for c in RFM) for m in means)
    return labelled.select(PERSON, kmeans.nearest_center(RFM, centers).alias("cluster"))


def _kmeans_roles(ks: list[int]) -> dict[str, str]:
    """The same steps in SQL: ``run<k>`` holds the centres of every step, ``centers<k>`` the last ones in order."""
    roles = {
        "gaps": "SELECT * FROM gappy_rfm WHERE monetary_value IS NULL",
        "known": "SELECT * FROM gappy_rfm WHERE monetary_value IS NOT NULL",
        "close": """SELECT a.customer_unique_id, b.monetary_value FROM gaps a, known b
            QUALIFY row_number() OVER (PARTITION BY a.customer_unique_id ORDER BY
                (a.recency - b.recency) ** 2 + (a.frequency - b.frequency) ** 2, b.customer_unique_id) <= 2""",
        "filled": """SELECT customer_unique_id, recency, frequency, monetary_value FROM known UNION ALL
            SELECT customer_unique_id, recency, frequency, m FROM gaps
            JOIN (SELECT customer_unique_id, avg(monetary_value) AS m FROM close GROUP BY 1) USING (customer_unique_id)""",
        "standard": """SELECT customer_unique_id, (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS x,
            (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () AS y,
            (monetary_value - avg(monetary_value) OVER ()) / stddev_pop(monetary_value) OVER () AS z FROM filled""",
        "points": "SELECT x, y, z, count(*) AS w FROM standard GROUP BY ALL",
    }
    for k in ks:
        shares = [(i + 0.5) / k for i in range(k)]
        start = ", ".join(f"{{'x': qx[{i}], 'y': qy[{i}], 'z': qz[{i}]}}" for i in range(1, k + 1))
        roles[f"run{k}"] = f"""SELECT 0 AS step, 1e9::DOUBLE AS moved, [{start}] AS cs
            FROM (SELECT quantile_cont(x, {shares}) AS qx, quantile_cont(y, {shares}) AS qy, quantile_cont(z, {shares}) AS qz FROM points)
            UNION ALL
            SELECT step + 1, list_max([sqrt((cs[i].x - now[i].x) ** 2 + (cs[i].y - now[i].y) ** 2 + (cs[i].z - now[i].z) ** 2)
                FOR i IN range(1, {k + 1})]), now
            FROM (SELECT step, cs, [CASE WHEN list_position(nos, i) IS NULL THEN far[i - len(list_filter(nos, lambda n: n < i))]
                    ELSE ms[list_position(nos, i)] END FOR i IN range(1, {k + 1})] AS now
                FROM (SELECT step, any_value(cs) AS cs, any_value(nos) AS nos, any_value(ms) AS ms,
                        list({{'x': x, 'y': y, 'z': z}} ORDER BY list_min({_distances("ms")}) DESC, x, y, z) AS far
                    FROM (SELECT step, any_value(cs) AS cs, list(no ORDER BY no) AS nos, list({{'x': x, 'y': y, 'z': z}} ORDER BY no) AS ms
                        FROM (SELECT step, any_value(cs) AS cs, no, round(sum(w * x) / sum(w), 9) AS x,
                                round(sum(w * y) / sum(w), 9) AS y, round(sum(w * z) / sum(w), 9) AS z
                            FROM (SELECT step, cs, x, y, z, w, {_nearest("cs")} AS no FROM run{k}, points WHERE moved > 1e-4 AND step < 300)
                            GROUP BY step, no)
                        GROUP BY step), points
                    GROUP BY step))"""
        roles[f"centers{k}"] = f"SELECT list_sort(cs) AS cs FROM run{k} ORDER BY step DESC LIMIT 1"
    return roles


def _distances(centers: str) -> str:
    return f"[(x - c.x) ** 2 + (y - c.y) ** 2 + (z - c.z) ** 2 FOR c IN {centers}]"


def _nearest(centers: str) -> str:
    return f"list_position({_distances(centers)}, list_min({_distances(centers)}))"


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


_LABELLED = f"""SELECT customer_unique_id, gappy_rfm.recency, gappy_rfm.frequency, gappy_rfm.monetary_value,
    CAST({_nearest("cs")} - 1 AS INTEGER) AS cluster FROM standard JOIN gappy_rfm USING (customer_unique_id), centers4"""


@query(
    "kmeans4",
    _recursive(
        with_roles(
            """SELECT customer_unique_id, recency, frequency, round(monetary_value, 4) AS monetary_value, cluster FROM labelled""",
            "gappy_rfm",
            **_kmeans_roles([4]),
            labelled=_LABELLED,
        )
    ),
)
def kmeans4(r):
    _, labelled = clustering.segment(clustering.prepare(_gappy_rfm(r)))
    return rounded(labelled, 4, "monetary_value")


@query(
    "cluster_profile",
    _recursive(
        with_roles(
            "SELECT cluster, "
            + ", ".join(f"round(median({c}), 4) AS {c}" for c in RFM)
            + " FROM labelled GROUP BY cluster",
            "gappy_rfm",
            **_kmeans_roles([4]),
            labelled=_LABELLED,
        )
    ),
)
def cluster_profile(r):
    _, labelled = clustering.segment(clustering.prepare(_gappy_rfm(r)))
    return rounded(clustering.cluster_profile(labelled), 4, *RFM)


@query(
    "kmeans_elbow",
    _recursive(
        with_roles(
            "SELECT CAST(1 AS INTEGER) AS k, round(sum(w * (x * x + y * y + z * z)), 4) AS inertia FROM points"
            + "".join(
                f" UNION ALL SELECT {k}, round(sum(w * list_min({_distances('cs')})), 4) FROM points, centers{k}" for k in range(2, 10)
            ),
            "gappy_rfm",
            **_kmeans_roles(list(range(2, 10))),
        )
    ),
)
def kmeans_elbow(r):
    prepared = clustering.prepare(_gappy_rfm(r))
    points = materialise(prepared.points, "rfm-points")
    models = kmeans.fit_many(points, clustering.SCALED, list(range(2, 10)))
    found = r.spark.createDataFrame(kmeans.elbow(points, clustering.SCALED, models), "k int, inertia double")
    return rounded(found, 4, "inertia")


def _sweep_roles(ks: list[int]) -> dict[str, str]:
    """``scores``: the Euclidean silhouette of each k, every point weighing as often as it occurs."""
    between = "sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)"
    return {
        "sides_of": " UNION ALL ".join(f"SELECT {k} AS k, x, y, z, w, {_nearest('cs')} AS no FROM points, centers{k}" for k in ks),
        "means": f"""SELECT a.k, a.x, a.y, a.z, a.w, a.no, b.no AS other, sum(b.w) AS n, sum(b.w * {between}) AS total
            FROM sides_of a JOIN sides_of b ON a.k = b.k GROUP BY ALL""",
        "sides": """SELECT k, x, y, z, w, max(CASE WHEN no = other THEN n END) AS n,
            max(CASE WHEN no = other AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN no <> other THEN total / n END) AS b
            FROM means GROUP BY k, x, y, z, w""",
        "scores": f"SELECT k, round(sum(w * {_SCORE.removeprefix('avg')}) / sum(w), 6) AS silhouette FROM sides GROUP BY k",
    }


@query(
    "kmeans_sweep",
    _recursive(
        with_roles(
            "SELECT CAST(1 AS INTEGER) AS k, round(sum(w * (x * x + y * y + z * z)), 4) AS inertia, NULL::DOUBLE AS silhouette FROM points"
            + "".join(
                f""" UNION ALL SELECT {k}, round(sum(w * list_min({_distances('cs')})), 4), (SELECT silhouette FROM scores WHERE k = {k})
                FROM points, centers{k}"""
                for k in range(2, 10)
            ),
            "gappy_rfm",
            **_kmeans_roles(list(range(2, 10))),
            **_sweep_roles(list(range(2, 10))),
        )
    ),
)
def kmeans_sweep(r):
    found = clustering.sweep(clustering.prepare(_gappy_rfm(r)))
    return found.withColumns({"inertia": F.round("inertia", 4), "silhouette": F.round("silhouette", 6)})


# --- Shared inputs -----------------------------------------------------------------------------


def _clean_reviews(r: Roles) -> DataFrame:
    return rows.delete_duplicates(r.order_reviews, ["review_id"])


def _centroids(r: Roles) -> DataFrame:
    return locations.centroids(locations.clean_points(r.geolocation))


def _located(r: Roles) -> DataFrame:
    return locations.located_zips(locations.clean_points(r.geolocation), r.customers, r.sellers)


def _rfm(r: Roles) -> DataFrame:
    return views.rfm(r.orders, r.customers, r.order_items, AS_OF)


def _gappy_rfm(r: Roles) -> DataFrame:
    """The RFM table over all lines; every seventh person lacks the monetary value."""
    table = _rfm(r).withColumn("frequency", F.col("frequency").cast("double"))
    return table.withColumn("monetary_value", F.when(F.col(PERSON) % 7 != 0, F.col("monetary_value")))


def _scored(r: Roles) -> DataFrame:
    return segments.rfm_scores(materialise(_rfm(r), "rfm"))


def _scaled(r: Roles) -> DataFrame:
    return scaling.standard_scale(materialise(_rfm(r), "rfm"), RFM)


def _labelled(r: Roles) -> DataFrame:
    """Scaled features with the recency fifth as a fixed cluster label."""
    table = materialise(_rfm(r), "rfm")
    scores = segments.rfm_scores(table)
    copies = scores.select(PERSON, "R", *RFM)
    return materialise(scaling.standard_scale(copies, RFM), "labelled")
