"""Text clean-up and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens read as missing by default when a CSV is loaded.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def na_to_null(value: Column) -> Column:
    """Null when the text is one of the missing-value tokens."""
    return F.when(~value.isin(*NA_TOKENS), value)


def number_to_string(value: Column) -> Column:
    """Text of a number; a whole double has no decimals (40.0 gives ``40``)."""
    number = value.cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    return F.when(whole, number.try_cast("bigint").cast("string")).otherwise(number.cast("string"))


def exceeds_length(value: Column, limit: int) -> Column:
    """True when the text does not fit VARCHAR(limit); trailing spaces do not count."""
    return F.length(F.rtrim(value)) > limit


def is_filled(*columns: Column) -> Column:
    """True when every column is neither null nor empty."""
    result = F.lit(True)
    for column in columns:
        result = result & column.isNotNull() & (column != "")
    return F.coalesce(result, F.lit(False))
