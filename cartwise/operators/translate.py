"""Translation of terms through a supplied dictionary table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def translate(df: DataFrame, column: str, dictionary: DataFrame, into: str) -> DataFrame:
    """Add ``into`` with the translation of ``column``; null when the term is unknown.

    ``dictionary`` has columns (term, translation) with each term once.
    """
    entries = dictionary.select(F.col("term").alias("_term"), F.col("translation").alias(into))
    return df.join(entries, F.col(column) == F.col("_term"), "left").drop("_term")


def untranslated(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Distinct present terms the dictionary lacks."""
    terms = df.select(F.col(column).alias("term")).where("term IS NOT NULL").distinct()
    return terms.join(dictionary.select("term"), "term", "left_anti")
