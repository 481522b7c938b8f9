"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_points
from compare import connect, planned, rows

FOLDER = "/root/testdata/sf0.001"
OWN = set(entry_points.QUERIES)
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert OWN == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, database, name):
    df = entry_points.queries()[name](spark, FOLDER)
    found, plan = df.toPandas(), planned(df)
    expected = database.execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)
    # Nothing is paired with everything, and no window holds the whole table in one task.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Window \[[^\n]*windowspecdefinition\((?:\w+#\d+L? (ASC|DESC)|specifiedwindowframe)", plan)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).columns == ["customer_unique_id", "recency", "frequency", "monetary_value"]
    assert entry_points.entry(spark).count() > 0


def test_iterative_queries_cover_every_person(spark):
    persons = entry_points.queries()["rfm"](spark, FOLDER).count()
    assert entry_points.queries()["kmeans4"](spark, FOLDER).count() == persons
    assert entry_points.queries()["cluster_profile"](spark, FOLDER).count() == 4
    sweep = entry_points.queries()["kmeans_sweep"](spark, FOLDER).collect()
    assert sorted(r.k for r in sweep) == list(range(1, 10))
    assert all(-1 <= r.silhouette <= 1 for r in sweep if r.k > 1)
