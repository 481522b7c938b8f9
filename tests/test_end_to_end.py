"""From a folder of CSV files to clusters."""

import pytest

from cartwise.operators.quality import check_tables
from cartwise.operators.segments import rfm_scores, segment_counts
from cartwise.plans import clustering, views
from cartwise.plans.load import load_folder
from cartwise.schemas import ENTITIES
from cartwise.session import materialise
from cartwise.sources.tables import write_csv
from cartwise.testbed.roles import AS_OF, Roles

RAW = "customers orders order_items order_payments order_reviews products sellers geolocation".split()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    roles = Roles(spark, "/root/testdata/sf0.001")
    for name in RAW:
        write_csv(getattr(roles, name), f"{root}/in/{name}_dataset.csv")
    write_csv(roles.brazil_states, f"{root}/in/brazil_states.csv")
    rejects = {}
    tables = load_folder(spark, f"{root}/in", f"{root}/out", rejects=rejects)
    return roles, tables, rejects


def test_every_table_is_loaded_whole(loaded):
    roles, tables, rejects = loaded
    assert set(tables) == {*RAW, "brazil_states", "geolocation_bis"}
    for name in ("customers", "orders", "order_items", "order_payments", "products", "sellers"):
        assert tables[name].count() == getattr(roles, name).count()
    assert all(n == 0 for o in rejects.values() for n in o.get.values())


def test_views_answer_sql(spark, loaded):
    roles, tables, _ = loaded
    assert set(views.register_views(tables)) == set(views.VIEWS)
    direct = views.avg_margin(roles.orders, roles.customers, roles.order_items).first().avg_margin
    assert spark.sql("SELECT avg_margin FROM avg_margin").first()[0] == pytest.approx(direct)


def test_checks_find_only_the_repeated_lines(loaded):
    _, tables, _ = loaded
    found = check_tables({n: t for n, t in tables.items() if n in ENTITIES}).where("violations > 0").collect()
    assert {(r.table_name, r.check) for r in found} == {("order_items", "primary key"), ("order_payments", "primary key")}


def test_scores_and_clusters(loaded):
    _, tables, _ = loaded
    rfm = materialise(views.rfm(tables["orders"], tables["customers"], tables["order_items"], AS_OF), "rfm")
    persons = rfm.count()
    assert sum(r["count"] for r in segment_counts(rfm_scores(rfm)).collect()) == persons
    prepared = clustering.prepare(rfm)
    assert clustering.sweep(prepared, range(2, 4)).count() == 3
    _, labelled = clustering.segment(prepared)
    assert labelled.count() == persons and clustering.cluster_profile(labelled).count() == 4
