"""Table scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether something was written to ``path``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def scan_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **properties: str
) -> DataFrame:
    """A relational table read in parallel ranges of a numeric key.

    The database's JDBC driver must be on the session's class path.
    """
    return spark.read.jdbc(url, table, key, lower, upper, partitions, properties=properties)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite the Parquet table at ``path`` and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_table(df: DataFrame, path: str) -> DataFrame:
    """Add rows to the Parquet table at ``path`` and return it as read back."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Folder of CSV parts with a header each; one file per task, never gathered."""
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
