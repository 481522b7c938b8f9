"""Hand-worked rows for cleaning, joins, views and checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartwise.functions import dates, geo, text
from cartwise.operators import joins, locations, quality, rows, translate
from cartwise.plans import views

ZIP, LAT, LNG = locations.ZIP, locations.LAT, locations.LNG
POINT = f"{ZIP} string, {LAT} double, {LNG} double, geolocation_city string, geolocation_state string"


def values(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def test_delete_duplicates_removes_every_copy_and_keeps_nulls(table):
    reviews = table([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "review_id string, n int")
    assert values(rows.delete_duplicates(reviews, ["review_id"]), "n") == [(3,), (4,), (5,)]


def test_delete_duplicates_beyond_the_hot_keys(table, monkeypatch):
    monkeypatch.setattr(rows, "HOT_KEYS", 1)
    data = [(k, i) for k in range(5) for i in range(k + 1)]
    assert values(rows.delete_duplicates(table(data, "k int, i int"), ["k"])) == [(0, 0)]


def test_delete_duplicates_on_several_keys(table):
    points = table(
        [("z1", 1.0, 1.0), ("z1", 1.0, 1.0), ("z2", 2.0, 2.0), ("z3", None, 3.0), ("z3", None, 3.0)],
        f"{ZIP} string, {LAT} double, {LNG} double",
    )
    assert [z for (z,) in values(locations.clean_points(points), ZIP)] == ["z2", "z3", "z3"]


def test_keep_first(table):
    data = table([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 7, "n"), (None, 6, "m")], "k string, o int, v string")
    kept = rows.delete_duplicates(data, ["k"], keep="first", order_by=["o"])
    assert values(kept, "v") == [("m",), ("n",), ("y",), ("z",)]
    with pytest.raises(ValueError):
        rows.delete_duplicates(data, ["k"], keep="last")


def test_located_zips(table):
    points = table(
        [
            ("z1", 1.0, 1.0, "A", "S"),
            ("z1", 1.0, 1.0, "A", "S"),
            ("z2", 2.0, 4.0, "B", "S"),
            ("z2", 4.0, 8.0, "C", "S"),
        ],
        POINT,
    )
    located = locations.centroids(locations.clean_points(points))
    assert values(located) == [("z2", 3.0, 6.0, "C", "S", 2)]
    customers = table([("z1",), ("z1",), ("z2",), (None,)], "customer_zip_code_prefix string")
    filled = locations.fill_customer_zips(located, customers)
    assert values(filled) == [("z1", None, None, None, None, 0), ("z2", 3.0, 6.0, "C", "S", 2)]
    sellers = table([("z9",), ("z9",), ("z2",)], "seller_zip_code_prefix string")
    final = locations.upsert_seller_zips(filled, sellers)
    assert [z for (z,) in values(final, ZIP)] == ["z1", "z2", "z9"]


def test_zip_bridge_repeats_per_match(table):
    customers = table([("c1", "z1"), ("c2", "z1"), ("c3", "z2")], "customer_id string, customer_zip_code_prefix string")
    points = table([("z1", 1.0), ("z1", 2.0), (None, 3.0)], f"{ZIP} string, {LAT} double")
    bridge = joins.zip_bridge(customers, points)
    assert bridge.count() == 4 and bridge.select("geolocation_id").distinct().count() == 2
    twice = joins.with_point_ids(points.union(points))
    assert twice.count() == 6 and twice.select("geolocation_id").distinct().count() == 6


def test_upsert_source_wins(table):
    base = table([("a", 1), ("b", 2)], "k string, v int")
    assert values(rows.upsert(base, table([("b", 9), ("c", 3)], "k string, v int"), ["k"])) == [("a", 1), ("b", 9), ("c", 3)]


def test_update_column_can_set_null(table):
    base = table([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    assert values(rows.update_column(base, table([("a", 7), ("b", None)], "k string, v int"), "k", "v")) == [
        ("a", 7),
        ("b", None),
        ("c", 3),
    ]


def test_append_rows_checks_the_key(table):
    base = table([("a", "x")], "k string, v string")
    added = rows.append_rows(base, table([("a", "y"), ("b", "z"), (None, "n")], "k string, v string"), ["k"])
    assert values(added) == [("a", "x"), ("b", "z")]


def test_null_keys_match_only_in_merge(table):
    left, right = table([(None, 1), ("a", 2)], "k string, l int"), table([(None, 3), ("b", 4)], "k string, r int")
    assert values(joins.merge(left, right, "k")) == [(None, 1, 3)]
    assert left.join(right, "k").count() == 0


def test_payments_times_items(table):
    payments = table([("o", 1.0), ("o", 2.0)], "order_id string, payment_value double")
    orders = table([("o", "c", "2018-03-01")], "order_id string, customer_id string, order_purchase_timestamp string")
    customers = table(
        [("c", "p", "01000", "X", "SP")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    states = table([("SP", "Southeast")], "abbreviation string, region string")
    items = table([("o", f"p{i}", "s", 1.0) for i in range(3)], "order_id string, product_id string, seller_id string, price double")
    assert views.payments_orders_customers_items(payments, orders, customers, states, items).count() == 6


@pytest.fixture
def shop(table):
    orders = table(
        [
            ("o1", "c1", "2018-03-05 10:00:00"),
            ("o2", "c2", "2018-04-01 00:00:00"),
            ("o3", "c1", "2018-04-30 23:59:59"),
            ("o4", "gone", "2018-04-02 08:00:00"),
        ],
        "order_id string, customer_id string, t string",
    ).select("order_id", "customer_id", F.col("t").cast("timestamp_ntz").alias("order_purchase_timestamp"))
    customers = table(
        [("c1", "p", "01000", "X", "SP"), ("c2", "p", "01000", "X", "SP"), ("c3", "q", "02000", "Y", "??")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    states = table([("SP", "Southeast")], "abbreviation string, region string")
    items = table(
        [("o1", "a", "s", 10.0), ("o1", "b", "s", 5.0), ("o3", None, "s", 2.0)],
        "order_id string, product_id string, seller_id string, price double",
    )
    return orders, customers, states, items


def test_cohorts(shop):
    orders, customers, _, _ = shop
    march, april = dt.datetime(2018, 3, 1), dt.datetime(2018, 4, 1)
    assert values(views.new_customers_month(orders, customers)) == [(march, "SP", "p", 1)]
    assert values(views.repurchases_month(orders, customers)) == [(april, "SP", "p", 2)]


def test_one_row_per_order(shop):
    view = views.orders_customers_items(*shop)
    assert values(view, "order_id", "total_items_sold", "total_price") == [
        ("o1", 2, 15.0),
        ("o2", None, None),
        ("o3", 0, 2.0),
        ("o4", None, None),
    ]
    assert values(view.where("region IS NULL"), "order_id") == [("o4",)]


def test_rfm_keeps_the_unknown_person(shop):
    orders, customers, _, items = shop
    assert values(views.rfm(orders, customers, items)) == [("p", 245.0, 3, 17.0), (None, 273.0, 1, None)]
    assert values(views.avg_margin(orders, customers, items)) == [(pytest.approx(0.51),)]


def test_rfm_equals_the_literal_view(shop):
    orders, customers, states, items = shop
    literal = (
        views.orders_customers_items(orders, customers, states, items)
        .groupBy("customer_unique_id")
        .agg(F.max("order_purchase_timestamp"), F.count("order_id"), F.sum("total_price"))
    )
    assert values(literal) == values(views.last_frequency_monetary(orders, customers, items))


def test_notebook_rfm(table, shop):
    orders, customers, _, _ = shop
    extra = table([(None, None)], "order_id string, customer_id string").withColumn(
        "order_purchase_timestamp", F.lit("2018-12-31 13:00:00").cast("timestamp_ntz")
    )
    payments = table(
        [("o1", 4.0), ("o1", 6.0), ("o2", None), (None, 1.5), (None, 2.5)], "order_id string, payment_value double"
    )
    people = customers.select("customer_id", "customer_unique_id").unionByName(
        table([(None, "n"), ("c9", None)], "customer_id string, customer_unique_id string")
    )
    found = views.rfm_payments(orders.unionByName(extra), payments, people, "2018-12-31 12:00:00")
    # The null order meets the null payments and the null customer; its one hour ahead floors to -1.
    assert values(found) == [("n", -1, 0, 4.0), ("p", 274, 2, 10.0)]


def test_notebook_rfm_all_null_values_sum_to_zero(table, shop):
    orders, customers, _, _ = shop
    payments = table([("o2", None)], "order_id string, payment_value double")
    found = views.rfm_payments(orders, payments, customers, "2019-01-01")
    assert values(found, "monetary_value") == [(0.0,)]


def test_register_views(spark, shop):
    orders, customers, states, items = shop
    names = views.register_views({"orders": orders, "customers": customers, "brazil_states": states, "order_items": items})
    assert "rfm" in names and "order_infos" not in names
    assert spark.sql("SELECT count(*) FROM orders_customers_items").first()[0] == 4


@pytest.mark.parametrize(
    "ts, truncated, floored",
    [
        ("2018-12-30 13:00:00", 1.0, 1),
        ("2019-01-01 13:00:00", 0.0, -1),
        ("2019-01-01 00:00:00", 0.0, 0),
        ("2019-01-02 00:00:00", -1.0, -1),
        ("2018-12-31 00:00:00.000001", 0.0, 0),
        (None, None, None),
    ],
)
def test_days(table, ts, truncated, floored):
    column = F.col("t").cast("timestamp_ntz")
    row = table([(ts,)], "t string").select(
        dates.whole_days_between(column, views.RFM_AS_OF), dates.floor_days_between(column, views.RFM_AS_OF)
    )
    assert values(row) == [(truncated, floored)]


def test_days_equal_python(spark):
    rng = random.Random(0)
    anchor = dt.datetime(2018, 11, 4, 0, 30, 0, 7)
    gaps = [dt.timedelta(days=rng.randint(-400, 400), seconds=rng.randint(0, 86400), microseconds=rng.randint(0, 9)) for _ in range(500)]
    rows_in = [(i, anchor - gap) for i, gap in enumerate(gaps)]
    column = F.col("t")
    found = spark.createDataFrame(rows_in, "i int, t timestamp_ntz").select(
        "i", dates.whole_days_between(column, str(anchor)), dates.floor_days_between(column, str(anchor))
    )
    expected = [(i, float(int(gap / dt.timedelta(days=1))), gap.days) for i, gap in enumerate(gaps)]
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_geopoint_needs_both_coordinates(table):
    data = table([(0.0, 1.0), (None, 1.0), (-23.5, -46.6)], "lat double, lng double")
    points = data.select(geo.geopoint(F.col("lat"), F.col("lng")).alias("p")).select("p.x", "p.y")
    assert values(points.where("x IS NOT NULL")) == [(-46.6, -23.5)]


def test_mercator_known_point(table):
    row = table([(-23.55, -46.63)], "lat double, lng double").select(
        geo.mercator_x(F.col("lng")), geo.mercator_y(F.col("lat")), geo.mercator_y(F.col("lat"), spherical=True)
    )
    x, y, web = row.first()
    assert (round(x), round(y), round(web)) == (-5190828, -2681603, -2698669)


def test_text_functions(table):
    numbers = table([(40.0,), (40.5,), (None,), (-3.0,)], "x double").select(text.number_to_string(F.col("x")).alias("t"))
    assert values(numbers) == [("-3",), ("40",), ("40.5",), (None,)]
    lengths = table([("ab   ", 2), ("abc", 2)], "t string, n int").select(text.exceeds_length(F.col("t"), 2))
    assert [r[0] for r in lengths.collect()] == [False, True]
    names = table([("a", "b"), ("a", ""), (None, "b")], "e string, f string")
    assert [r[0] for r in names.select(text.is_filled(F.col("e"), F.col("f"))).collect()] == [True, False, False]


def test_translation(table):
    terms = table([("small",), ("odd",), ("odd",), (None,)], "term string")
    dictionary = table([("small", "petit")], "term string, translation string")
    named = translate.translate(terms.withColumnRenamed("term", "english"), "english", dictionary, "french")
    assert values(named) == [("odd", None), ("odd", None), ("small", "petit"), (None, None)]
    assert values(translate.untranslated(terms, "term", dictionary)) == [("odd",)]


def test_sort_puts_nulls_first(table):
    ordered = rows.sort_descending(table([(1, "a"), (None, "b"), (2, "d"), (2, "c")], "id int, v string"), "id")
    assert [tuple(r) for r in ordered.collect()] == [(None, "b"), (2, "c"), (2, "d"), (1, "a")]


def test_key_checks(table):
    child = table([("a",), ("a",), ("x",), (None,)], "k string")
    parent = table([("a",)], "k string")
    assert values(quality.primary_key_violations(child, ["k"])) == [("a", 2), (None, 1)]
    assert values(quality.foreign_key_violations(child, "k", parent, "k")) == [("x", 1)]


def test_check_tables_reports_every_check(table):
    sellers = table(
        [("s1", "z1", "C", "SPX"), ("s1", "z2", "C", "SP")],
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    )
    located = table([("z1", 0)], f"{ZIP} string, n int").select(
        ZIP, *[F.lit(None).cast(t).alias(c) for c, t in ((LAT, "double"), (LNG, "double"), ("geolocation_city", "string"), ("geolocation_state", "string"))], "n"
    )
    report = quality.check_tables({"sellers": sellers, "geolocation_bis": located}).where("violations > 0")
    assert values(report, "table_name", "check", "violations") == [
        ("sellers", "foreign key", 1),
        ("sellers", "length", 1),
        ("sellers", "primary key", 1),
    ]
