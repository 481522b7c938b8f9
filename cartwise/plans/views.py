"""Wide order and customer views, cohorts, margin and RFM.

Each view is a function from tables to a table. Views that repeat money values
because of their joins (payments with items, items with reviews) say so; never
sum those columns from them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.dates import floor_days_between, month_start, whole_days_between
from cartwise.operators.joins import MERGE_KEY, merge, with_merge_key

Join = Callable[[DataFrame, DataFrame, str], DataFrame]
CUSTOMER_PLACE = ["customer_zip_code_prefix", "customer_city", "customer_state", "region"]
RFM_AS_OF = "2019-01-01 00:00:00"
MARGIN_RATE = 0.03


def plain_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How views join facts unless ``operators.hot_keys.hot_join`` is handed in."""
    return left.join(right, key)


def _regions(states: DataFrame) -> DataFrame:
    return states.select(F.col("abbreviation").alias("customer_state"), "region")


def payments_orders(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment with its order's customer and time."""
    return payments.select("order_id", "payment_value").join(
        orders.select("order_id", "customer_id", "order_purchase_timestamp"), "order_id"
    )


def customers_region_inner(customers: DataFrame, states: DataFrame) -> DataFrame:
    """Customers in a known state, with its region; no person id."""
    return customers.join(_regions(states), "customer_state").select("customer_id", *CUSTOMER_PLACE)


def customers_region_left(customers: DataFrame, states: DataFrame) -> DataFrame:
    """All customers with the person id, and the region where the state is known."""
    joined = customers.join(_regions(states), "customer_state", "left")
    return joined.select("customer_id", "customer_unique_id", *CUSTOMER_PLACE)


def payments_orders_customers(
    payments: DataFrame, orders: DataFrame, customers: DataFrame, states: DataFrame, join: Join = plain_join
) -> DataFrame:
    """Payments with order and customer place."""
    # Customers go to their orders first: orders are fewer and less skewed than payments.
    placed = orders.select("order_id", "customer_id", "order_purchase_timestamp").join(
        customers_region_inner(customers, states), "customer_id"
    )
    return join(payments.select("order_id", "payment_value"), placed, "order_id").select(
        "order_id", "payment_value", "customer_id", "order_purchase_timestamp", *CUSTOMER_PLACE
    )


def payments_orders_customers_items(
    payments: DataFrame, orders: DataFrame, customers: DataFrame, states: DataFrame, items: DataFrame, join: Join = plain_join
) -> DataFrame:
    """Payments times items of the same order: values repeat, do not sum them."""
    paid = payments_orders_customers(payments, orders, customers, states, join)
    return join(paid, items.select("order_id", "product_id", "seller_id", "price"), "order_id")


def payments_orders_customers_items_products(
    payments: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    states: DataFrame,
    items: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """The view above with the product category."""
    # The category goes to the item before items are multiplied by payments.
    sold = items.select("order_id", "product_id", "seller_id", "price").join(
        products.select("product_id", "product_category_name"), "product_id"
    )
    return (
        payments_orders_customers(payments, orders, customers, states)
        .join(sold, "order_id")
        .select(
            "order_id",
            "customer_id",
            "order_purchase_timestamp",
            "payment_value",
            "price",
            "product_category_name",
            "product_id",
            "region",
            "customer_state",
            "customer_city",
            "customer_zip_code_prefix",
            "seller_id",
        )
    )


def order_infos(
    orders: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    located: DataFrame,
    join: Join = plain_join,
) -> DataFrame:
    """Delivery dates with both positions and the review; one row per item and review."""

    def positions(role: str) -> DataFrame:
        return located.select(
            F.col("geolocation_zip_code_prefix").alias(f"{role}_zip_code_prefix"),
            F.col("geolocation_lat").alias(f"{role}_lat"),
            F.col("geolocation_lng").alias(f"{role}_lng"),
        )

    # Positions go to the customer and seller dimensions before those meet the
    # facts, and each fact meets its dimension before items and reviews multiply.
    placed_customers = customers.select("customer_id", "customer_zip_code_prefix").join(
        positions("customer"), "customer_zip_code_prefix"
    )
    placed_sellers = sellers.select("seller_id", "seller_zip_code_prefix").join(
        positions("seller"), "seller_zip_code_prefix"
    )
    dates = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    placed_orders = orders.select("order_id", "customer_id", *dates).join(placed_customers, "customer_id")
    placed_items = items.select("order_id", "seller_id").join(placed_sellers, "seller_id")
    reviewed = reviews.select("order_id", "review_id", "review_creation_date")
    return join(join(placed_items, placed_orders, "order_id"), reviewed, "order_id").select(
        "customer_id",
        *dates,
        "customer_zip_code_prefix",
        "customer_lat",
        "customer_lng",
        "seller_id",
        "seller_zip_code_prefix",
        "seller_lat",
        "seller_lng",
        "review_id",
        "review_creation_date",
    )


def orders_customers(orders: DataFrame, customers: DataFrame, states: DataFrame) -> DataFrame:
    """Every order, with its customer where known."""
    return (
        orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(customers_region_left(customers, states), "customer_id", "left")
        .select("order_id", "customer_id", "customer_unique_id", "order_purchase_timestamp", *CUSTOMER_PLACE)
    )


def payments_by_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("total_payment_value"))


def items_by_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("product_id").alias("total_items_sold"), F.sum("price").alias("total_price")
    )


def orders_customers_payments(orders: DataFrame, customers: DataFrame, states: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order with its payment total."""
    return (
        orders_customers(orders, customers, states)
        .drop("customer_unique_id")
        .join(payments_by_order(payments), "order_id", "left")
    )


def orders_customers_items(orders: DataFrame, customers: DataFrame, states: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order with its item count and price total."""
    return orders_customers(orders, customers, states).join(items_by_order(items), "order_id", "left")


def person_months(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders per person, state and month."""
    # Orders combine per customer account and month before they meet the customer,
    # so an account with very many orders does not skew the join.
    monthly = orders.groupBy("customer_id", month_start(F.col("order_purchase_timestamp")).alias("purchase_month")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    people = customers.select("customer_id", "customer_state", "customer_unique_id")
    counted = F.when(F.col("customer_unique_id").isNotNull(), F.col("orders")).otherwise(0)
    return (
        monthly.join(people, "customer_id", "left")
        .groupBy("purchase_month", "customer_state", "customer_unique_id")
        .agg(F.sum(counted).alias("nb_purchases"))
    )


def new_customers_month(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Persons with exactly one order in the month (not their first ever)."""
    return person_months(orders, customers).where("nb_purchases = 1")


def repurchases_month(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Persons with more than one order in the month."""
    return person_months(orders, customers).where("nb_purchases > 1")


def last_frequency_monetary(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Last purchase, number of orders and item value per person.

    Same rows as aggregating the one-row-per-order view. Totals combine per
    account before the customer join, so that join moves accounts, not orders.
    """
    accounts = (
        orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(items_by_order(items).select("order_id", "total_price"), "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_purchase"),
            F.count("order_id").alias("frequency"),
            F.sum("total_price").alias("monetary_value"),
        )
    )
    return (
        accounts.join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            F.max("last_purchase").alias("last_purchase"),
            F.sum("frequency").alias("frequency"),
            F.sum("monetary_value").alias("monetary_value"),
        )
    )


def rfm(orders: DataFrame, customers: DataFrame, items: DataFrame, as_of: str = RFM_AS_OF) -> DataFrame:
    """Recency in whole days before ``as_of``, frequency and item value per person."""
    return last_frequency_monetary(orders, customers, items).select(
        "customer_unique_id",
        whole_days_between(F.col("last_purchase"), as_of).alias("recency"),
        "frequency",
        "monetary_value",
    )


def customer_margin(orders: DataFrame, customers: DataFrame, items: DataFrame, rate: float = MARGIN_RATE) -> DataFrame:
    """Margin per person: a share of the item value."""
    return last_frequency_monetary(orders, customers, items).select(
        "customer_unique_id", (F.lit(rate) * F.col("monetary_value")).alias("margin")
    )


def avg_margin(orders: DataFrame, customers: DataFrame, items: DataFrame, rate: float = MARGIN_RATE) -> DataFrame:
    """Mean margin over persons that have one."""
    return customer_margin(orders, customers, items, rate).agg(F.avg("margin").alias("avg_margin"))


def rfm_payments(orders: DataFrame, payments: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """The notebook's RFM: payment value, distinct orders, days rounded down.

    Null keys match each other in its joins, persons without an id are left out,
    and a person whose values are all null gets 0.0.
    """
    # Payments combine per order before they meet it; a repeated order still counts each time.
    paid = with_merge_key(payments, "order_id").groupBy(*MERGE_KEY).agg(F.sum("payment_value").alias("payment_value"))
    paid_orders = merge(orders.select("order_id", "customer_id", "order_purchase_timestamp"), paid, "order_id")
    people = customers.where("customer_unique_id IS NOT NULL").select("customer_id", "customer_unique_id")
    return (
        merge(paid_orders, people, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            floor_days_between(F.max("order_purchase_timestamp"), as_of).alias("recency"),
            F.count_distinct("order_id").alias("frequency"),
            F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("monetary_value"),
        )
    )


# View name -> function of the tables by role.
VIEWS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "payments_orders": lambda t: payments_orders(t["order_payments"], t["orders"]),
    "customers_region_inner": lambda t: customers_region_inner(t["customers"], t["brazil_states"]),
    "customers_region_left": lambda t: customers_region_left(t["customers"], t["brazil_states"]),
    "payments_orders_customers": lambda t: payments_orders_customers(
        t["order_payments"], t["orders"], t["customers"], t["brazil_states"]
    ),
    "payments_orders_customers_items": lambda t: payments_orders_customers_items(
        t["order_payments"], t["orders"], t["customers"], t["brazil_states"], t["order_items"]
    ),
    "payments_orders_customers_items_products": lambda t: payments_orders_customers_items_products(
        t["order_payments"], t["orders"], t["customers"], t["brazil_states"], t["order_items"], t["products"]
    ),
    "order_infos": lambda t: order_infos(
        t["orders"], t["order_items"], t["order_reviews"], t["sellers"], t["customers"], t["geolocation_bis"]
    ),
    "orders_customers": lambda t: orders_customers(t["orders"], t["customers"], t["brazil_states"]),
    "payments_by_order": lambda t: payments_by_order(t["order_payments"]),
    "orders_customers_payments": lambda t: orders_customers_payments(
        t["orders"], t["customers"], t["brazil_states"], t["order_payments"]
    ),
    "items_by_order": lambda t: items_by_order(t["order_items"]),
    "orders_customers_items": lambda t: orders_customers_items(
        t["orders"], t["customers"], t["brazil_states"], t["order_items"]
    ),
    "new_customers_month": lambda t: new_customers_month(t["orders"], t["customers"]),
    "repurchases_month": lambda t: repurchases_month(t["orders"], t["customers"]),
    "customer_margin": lambda t: customer_margin(t["orders"], t["customers"], t["order_items"]),
    "avg_margin": lambda t: avg_margin(t["orders"], t["customers"], t["order_items"]),
    "last_frequency_monetary": lambda t: last_frequency_monetary(t["orders"], t["customers"], t["order_items"]),
    "rfm": lambda t: rfm(t["orders"], t["customers"], t["order_items"]),
}


class _Tables(dict):
    """Tables by role; remembers that one was missing, so that no other error passes for it."""

    class Missing(Exception):
        pass

    def __missing__(self, name):
        raise self.Missing(name)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make every view whose tables are present available to SQL, as ``prefix`` and its name; returns the names."""
    registered, own = [], _Tables(tables)
    for name, table in tables.items():
        table.createOrReplaceTempView(prefix + name)
    for name, view in VIEWS.items():
        try:
            frame = view(own)
        except _Tables.Missing:
            continue
        frame.createOrReplaceTempView(prefix + name)
        registered.append(name)
    return registered
