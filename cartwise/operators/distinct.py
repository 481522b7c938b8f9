"""Approximate distinct counts from sketches that are stored by group and merged later.

A sketch (HyperLogLog) has a bounded size whatever it counts. Those of parts of the data, say of every day, merge
into that of the whole, so a count over any parts reads the sketches alone. Nulls are not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 to this power registers in a sketch.
SIZE = 14


def relative_error(size: int = SIZE) -> float:
    """Three standard errors of an estimate, as a share of the count."""
    return 3 * 1.04 / 2 ** (size / 2)


def distinct_sketches(df: DataFrame, by: list[str], columns: list[str], size: int = SIZE) -> DataFrame:
    """``by`` and for each column its sketch; values are counted as their text."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(size)).alias(c) for c in columns])


def merge_sketches(sketches: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Sketches of fewer, larger groups; tables of sketches are put together with ``unionByName`` before."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def estimates(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """The sketches read as counts."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in columns})
