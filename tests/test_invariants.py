"""Properties that hold on any data, checked on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from cartwise.operators import rows, segments
from cartwise.operators.locations import ZIP, clean_points, located_zips
from cartwise.plans import views
from cartwise.testbed.roles import AS_OF, Roles


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, "/root/testdata/sf0.001")


def test_cohorts_split_the_person_months(roles):
    keys = ["purchase_month", "customer_state", "customer_unique_id"]
    new = views.new_customers_month(roles.orders, roles.customers).select(*keys)
    again = views.repurchases_month(roles.orders, roles.customers).select(*keys)
    assert new.join(again, keys, "left_semi").count() == 0
    months = views.person_months(roles.orders, roles.customers).where("customer_unique_id IS NOT NULL")
    assert new.count() + again.count() == months.count()


def test_one_row_per_order(roles):
    view = views.orders_customers_items(roles.orders, roles.customers, roles.brazil_states, roles.order_items)
    assert view.count() == view.select("order_id").distinct().count() == roles.orders.count()


def test_cleaned_tables_have_no_repeated_key(roles):
    assert rows.duplicate_keys(rows.delete_duplicates(roles.order_reviews, ["review_id"]), ["review_id"]).count() == 0
    keys = [ZIP, "geolocation_lat", "geolocation_lng"]
    assert rows.duplicate_keys(clean_points(roles.geolocation), keys).count() == 0


def test_every_zip_is_located_once(roles):
    located = located_zips(clean_points(roles.geolocation), roles.customers, roles.sellers)
    zips = roles.customers.select(F.col("customer_zip_code_prefix").alias(ZIP)).union(
        roles.sellers.select("seller_zip_code_prefix")
    )
    assert zips.join(located, ZIP, "left_anti").count() == 0
    assert located.count() == located.select(ZIP).distinct().count()


def test_segments_hold_every_person(roles):
    table = views.rfm(roles.orders, roles.customers, roles.order_items, AS_OF).dropna()
    counts = segments.segment_counts(segments.rfm_scores(table))
    assert counts.agg(F.sum("count")).first()[0] == table.count()


def test_totals_survive_the_reduction_to_accounts(roles):
    """Sums over persons equal sums over items: nothing is dropped or counted twice."""
    per_person = views.last_frequency_monetary(roles.orders, roles.customers, roles.order_items)
    row = per_person.agg(F.sum("frequency").alias("orders"), F.sum("monetary_value").alias("value")).first()
    assert row.orders == roles.orders.count()
    assert row.value == pytest.approx(roles.order_items.agg(F.sum("price")).first()[0])
