"""Standard scores with the population deviation, and the one-cluster inertia."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, columns: list[str]) -> Column:
    """Mean and population deviation of every column as one scalar subquery."""
    fields = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns]
    return df.agg(F.struct(*fields).alias("moments")).scalar()


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes zero."""
    stats = moments(df, columns)

    def scaled(c: str) -> Column:
        sd = stats[c]["sd"]
        return ((F.col(c) - stats[c]["mean"]) / F.when(sd == 0, 1.0).otherwise(sd)).alias(c)

    return df.select(*[scaled(c) if c in columns else F.col(c) for c in df.columns])


def inertia_of_one(df: DataFrame, columns: list[str], weight: str | None = None) -> DataFrame:
    """Sum of squared distances to the mean: the inertia at k = 1."""
    w = F.col(weight) if weight else F.lit(1.0)
    if weight is None:
        # Variance times count keeps precision when the mean is far from zero.
        parts = [F.var_pop(c) * F.count(c) for c in columns]
    else:
        parts = [F.sum(w * F.col(c) * F.col(c)) - F.sum(w * F.col(c)) ** 2 / F.sum(w) for c in columns]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return df.agg(total.alias("inertia"))
