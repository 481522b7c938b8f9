"""Key, reference and length checks as reports of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.text import exceeds_length
from cartwise.operators.rows import all_present
from cartwise.schemas import ENTITIES


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are repeated or have a null part, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | ~all_present(keys))


def foreign_key_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with their number of rows; null keys pass.

    The child is reduced to one row per key before the join.
    """
    counts = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Per text column, how many values do not fit their VARCHAR length (one pass)."""
    counts = df.agg(*[F.count_if(exceeds_length(F.col(c), n)).alias(c) for c, n in limits.items()])
    report = counts.unpivot([], list(limits), "column_name", "violations")
    return report.withColumn("max_length", F.element_at(F.create_map(*_flat(limits)), F.col("column_name")))


def _flat(limits: dict[str, int]):
    return [F.lit(part) for pair in limits.items() for part in pair]


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared checks on the tables and columns present: (table, check, columns, violations)."""
    reports = []

    def add(table: str, check: str, columns: str, violations: DataFrame, total) -> None:
        reports.append(
            violations.agg(F.coalesce(total, F.lit(0)).cast("long").alias("violations")).select(
                F.lit(table).alias("table_name"), F.lit(check).alias("check"), F.lit(columns).alias("columns"), "violations"
            )
        )

    for name, df in tables.items():
        entity = ENTITIES[name]
        keys = list(entity.primary_key)
        if keys and set(keys) <= set(df.columns):
            add(name, "primary key", ", ".join(keys), primary_key_violations(df, keys), F.count(F.lit(1)))
        for column, parent, parent_column in entity.foreign_keys:
            if parent in tables and column in df.columns:
                found = foreign_key_violations(df, column, tables[parent], parent_column)
                add(name, "foreign key", f"{column} -> {parent}", found, F.sum("n_rows"))
        limits = {c: n for c, n in entity.lengths.items() if c in df.columns}
        if limits:
            found = length_violations(df, limits)
            reports.append(
                found.select(
                    F.lit(name).alias("table_name"),
                    F.lit("length").alias("check"),
                    F.concat_ws(" <= ", "column_name", F.col("max_length").cast("string")).alias("columns"),
                    F.col("violations").cast("long").alias("violations"),
                )
            )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def profile(df: DataFrame) -> DataFrame:
    """Column name, type and number of present values, from one pass."""
    types = {name: dtype for name, dtype in df.dtypes}
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "non_null")
    kinds = F.create_map(*[F.lit(part) for pair in types.items() for part in pair])
    return counts.select("column_name", F.element_at(kinds, F.col("column_name")).alias("data_type"), "non_null")
