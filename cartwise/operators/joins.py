"""Joins that need more than ``DataFrame.join``.

No join here carries a broadcast hint for a table that grows: Spark compares the
size of each side with ``spark.sql.autoBroadcastJoinThreshold`` when planning and
again at run time, broadcasts a small dimension by itself, and otherwise sorts,
merges and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


MERGE_KEY = ["_is_null", "_value"]


def with_merge_key(df: DataFrame, key: str) -> DataFrame:
    """Add two columns that are equal whenever the keys are, two nulls included.

    Grouping by them partitions the rows as ``merge`` needs them, so an aggregate
    that feeds a merge is not shuffled again.
    """
    if MERGE_KEY[0] in df.columns:
        return df
    dtype = df.schema[key].dataType
    filler = F.lit(0).cast(dtype) if isinstance(dtype, T.NumericType) else F.lit("")
    value = F.col(key) if isinstance(dtype, (T.NumericType, T.StringType)) else F.col(key).cast("string")
    return df.withColumns({MERGE_KEY[0]: F.col(key).isNull(), MERGE_KEY[1]: F.coalesce(value, filler)})


def merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join in which null keys match each other; one key column."""
    other = with_merge_key(right, key).drop(key)
    return with_merge_key(left, key).join(other, MERGE_KEY).drop(*MERGE_KEY)


def without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; null keys stay.

    Only the distinct keys of ``right`` are moved, so a frequent key there costs
    one row per task.
    """
    return left.join(right.select(key).distinct(), key, "left_anti")


def with_point_ids(points: DataFrame) -> DataFrame:
    """Add a unique ``geolocation_id`` to every row: a 128-bit digest of its values and a number among equal rows.

    No global counter is needed, and equal rows, however many, meet as a count.
    """
    columns = points.columns
    digest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"}))
    counted = points.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))
    numbered = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    named = F.concat_ws("-", digest, F.col("_copy").cast("string"))
    return numbered.withColumn("geolocation_id", named).drop("_copies", "_copy")


def zip_bridge(customers: DataFrame, points: DataFrame) -> DataFrame:
    """Customer to raw location point by zip; one row per match. Points without an id get one."""
    if "geolocation_id" not in points.columns:
        points = with_point_ids(points)
    numbered = points.select(F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"), "geolocation_id")
    placed = customers.select("customer_id", "customer_zip_code_prefix")
    return placed.join(numbered, "customer_zip_code_prefix").select(
        "customer_id", "customer_zip_code_prefix", "geolocation_id"
    )
