"""Row batches for numpy, whatever the columns are called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Bytes that go to Python at a time, one row at least: a batch of whole texts is held on both sides.
BATCH_BYTES = 1 << 22


def bounded(spark: SparkSession) -> SparkSession:
    """The session with batches bounded by their bytes; it holds for what is run later."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def map_batches(rows: DataFrame, function: Callable, schema) -> DataFrame:
    """``rows.mapInArrow`` for column names that hold dots or occur twice; ``function`` reads columns by place."""
    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).mapInArrow(function, schema)
