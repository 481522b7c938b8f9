"""Quantile scores of recency, frequency and monetary value, and segment sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.operators.quantiles import exact_quantiles, quantile_table

SCORES = {"R": "recency", "F": "frequency", "M": "monetary_value"}


def quantile_edges(df: DataFrame, columns: list[str], q: int = 5) -> dict[str, list[float]]:
    """Edges of q equal-frequency bins per column, minimum and maximum included."""
    edges = exact_quantiles(df, columns, [i / q for i in range(q + 1)])
    return {c: edges.get(c, []) for c in columns}


def edges_table(df: DataFrame, columns: list[str], q: int = 5) -> DataFrame:
    rows = [(c, i, float(e)) for c, edges in quantile_edges(df, columns, q).items() for i, e in enumerate(edges)]
    return df.sparkSession.createDataFrame(rows, "column_name string, edge_no int, edge double")


def quantile_score(value: Column, edges: list[float], reverse: bool = False) -> Column:
    """1 for the lowest bin; bins are closed on the right, equal edges are merged."""
    cuts = sorted({e for e in edges if e > min(edges)} - {max(edges)}) if edges else []
    score = F.lit(1)
    for cut in cuts:
        score = score + F.when(value > F.lit(cut), 1).otherwise(0)
    if reverse:
        score = F.lit(len(cuts) + 2) - score
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), score).cast("int")


def rfm_scores(df: DataFrame, q: int = 5, reverse_recency: bool = False) -> DataFrame:
    """Add R, F and M. R = 1 is the most recent fifth unless reversed.

    ``df`` is read several times: hand in a written table.
    """
    edges = quantile_edges(df, list(SCORES.values()), q)
    return df.withColumns(
        {
            label: quantile_score(F.col(c), edges[c], reverse=reverse_recency and label == "R")
            for label, c in SCORES.items()
        }
    )


def segment_counts(scored: DataFrame) -> DataFrame:
    """Persons per (R, F, M) with the three digits as a label; rows without a score are left out."""
    counts = scored.dropna(subset=list(SCORES)).groupBy(*SCORES).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("segment", F.concat(*[F.col(c).cast("string") for c in SCORES]))


def median_by_group(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Median of every column per group, nulls skipped, even counts interpolated.

    A group without values has null medians; rows without a group are left out. Any number of groups.
    ``df`` is read several times: hand in a written table.
    """
    own = df.filter(F.col(group).isNotNull())
    medians = quantile_table(own, columns, [0.5], by=group)
    wide = medians.groupBy("g").agg(*[F.max(F.when(F.col("c") == c, F.col("value"))).alias(c) for c in columns])
    groups = own.select(F.col(group).alias("own")).distinct()
    return groups.join(wide, F.col("own") == F.col("g"), "left").select(F.col("own").alias(group), *columns)
