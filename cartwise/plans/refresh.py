"""Cohort and customer views kept up to date from new orders alone.

The state of a view holds sums, counts and maxima by group, so what a load adds merges with what is stored. It is a snapshot
table by person: a refresh reads the load's facts, the accounts, and the partitions of the persons met; facts of earlier loads
are not read. A load holds whole orders with all their items, and its accounts are known when it is taken in. Loads are
numbered upwards. The number is stored with the state it led to, in one step, so a load that was cut off can be started
anew and one that was taken in is not counted twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.dates import whole_days_between
from cartwise.plans import views
from cartwise.session import materialise
from cartwise.sources import snapshots

PERSON = "customer_unique_id"


@dataclass(frozen=True)
class State:
    """Groups of a view, and for each other column how the values of two loads become one."""

    groups: tuple[str, ...]
    merged: tuple[Column, ...]

    def merge(self, held: DataFrame, added: DataFrame) -> DataFrame:
        return held.unionByName(added.select(*held.columns)).groupBy(*self.groups).agg(*self.merged)


def months() -> State:
    """Orders by person, state and month."""
    return State(("purchase_month", "customer_state", PERSON), (F.sum("nb_purchases").alias("nb_purchases"),))


def persons() -> State:
    """Last purchase, orders and item value by person."""
    merged = F.max("last_purchase").alias("last_purchase"), F.sum("frequency").alias("frequency")
    return State((PERSON,), (*merged, F.sum("monetary_value").alias("monetary_value")))


def take_in(path: str, state: State, added: DataFrame, load: int, partitions: int = 64) -> bool:
    """Merge a load's state into the stored one, or store the first; whether it was new."""
    spark = added.sparkSession
    if not snapshots.versions(spark, path):
        snapshots.overwrite(added, path, [PERSON], partitions, note=str(load))
        return True
    if load <= int(snapshots.manifest(spark, path).note):
        return False
    # Read twice: for the partitions it meets, and to be merged.
    snapshots.change(path, materialise(added, "load"), state.merge, note=str(load))
    return True


def load_months(path: str, orders: DataFrame, customers: DataFrame, load: int) -> bool:
    """Take new orders into the state that ``new_customers_month`` and ``repurchases_month`` read."""
    return take_in(path, months(), views.person_months(orders, customers), load)


def new_customers_month(spark: SparkSession, path: str) -> DataFrame:
    """Persons with exactly one order in the month, over all loads."""
    return snapshots.read(spark, path).where("nb_purchases = 1")


def repurchases_month(spark: SparkSession, path: str) -> DataFrame:
    """Persons with more than one order in the month, over all loads."""
    return snapshots.read(spark, path).where("nb_purchases > 1")


def load_persons(path: str, orders: DataFrame, customers: DataFrame, items: DataFrame, load: int) -> bool:
    """Take new orders and their items into the state that ``rfm`` and ``customer_margin`` read."""
    return take_in(path, persons(), views.last_frequency_monetary(orders, customers, items), load)


def last_frequency_monetary(spark: SparkSession, path: str) -> DataFrame:
    """Last purchase, orders and item value per person, over all loads."""
    return snapshots.read(spark, path)


def rfm(spark: SparkSession, path: str, as_of: str = views.RFM_AS_OF) -> DataFrame:
    """Recency, frequency and item value per person, over all loads."""
    recency = whole_days_between(F.col("last_purchase"), as_of).alias("recency")
    return snapshots.read(spark, path).select(PERSON, recency, "frequency", "monetary_value")


def customer_margin(spark: SparkSession, path: str, rate: float = views.MARGIN_RATE) -> DataFrame:
    """Margin per person, over all loads."""
    return snapshots.read(spark, path).select(PERSON, (F.lit(rate) * F.col("monetary_value")).alias("margin"))
