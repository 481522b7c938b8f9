"""Row removal, inserts and updates expressed as new tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys split off as "hot" before a join. After the 1,000 most frequent keys are
# gone, no remaining key can hold more than a thousandth of the rows.
HOT_KEYS = 1000


def all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their number of rows.

    Counting combines before the shuffle, so a hot key costs one row per task;
    a ROW_NUMBER window would sort all its rows in one task.
    """
    return df.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def delete_duplicates(df: DataFrame, keys: list[str], keep: str = "none", order_by: list[str] | None = None) -> DataFrame:
    """Remove rows whose key is repeated; rows with a null key part stay.

    ``keep="none"`` removes every copy. ``keep="first"`` leaves the copy that
    comes first in ``order_by`` (all columns decide when it is not given).
    """
    # Rows with a null key part never go through the shuffle, where they would all
    # meet in one task.
    keyed, unkeyed = df.where(all_present(keys)), df.where(~all_present(keys))
    if keep == "none":
        repeated = duplicate_keys(df, keys)
        # The rows of very frequent keys leave through a bounded broadcast, so the
        # shuffled anti join never gets one key with a large share of the table.
        hot = repeated.orderBy(F.desc("n_rows"), *keys).limit(HOT_KEYS).select(*keys)
        single = keyed.join(F.broadcast(hot), keys, "left_anti").join(repeated.select(*keys), keys, "left_anti")
        return single.unionByName(unkeyed)
    if keep != "first":
        raise ValueError("keep is 'none' or 'first'")
    rest = [c for c in df.columns if c not in (order_by or [])]
    ranking = F.struct(*(order_by or []), *rest)
    # min_by combines before the shuffle as well.
    kept = keyed.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), ranking).alias("row"))
    return kept.select("row.*").unionByName(unkeyed)


def append_missing(base: DataFrame, key: str, keys: DataFrame, **fill) -> DataFrame:
    """Add one row for every non-null key of ``keys`` that ``base`` lacks.

    Columns not named in ``fill`` are typed nulls. Keys already there stay as they are.
    """
    return base.unionByName(missing_rows(base, key, keys, **fill))


def missing_rows(base: DataFrame, key: str, keys: DataFrame, **fill) -> DataFrame:
    """The rows ``append_missing`` adds; each key once."""
    source = keys.toDF(key).where(F.col(key).isNotNull()).distinct()
    new = source.join(base.select(key), key, "left_anti")
    return new.select(
        *[
            F.col(key) if f.name == key else F.lit(fill.get(f.name)).cast(f.dataType).alias(f.name)
            for f in base.schema.fields
        ]
    )


def upsert(base: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` replace rows of ``base`` with the same key; others are added.

    ``source`` must hold each key once.
    """
    return base.join(source.select(*keys), keys, "left_anti").unionByName(source)


def update_column(base: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """Set ``column`` from ``changes(key, column)``, which lists each key once."""
    new = changes.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = base.join(new, key, "left")
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return joined.select(*[value.alias(c) if c == column else F.col(c) for c in base.columns])


def append_rows(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add dimension rows; a row whose key exists already (or is null) is not taken."""
    fresh = rows.where(all_present(keys)).dropDuplicates(keys).join(base.select(*keys), keys, "left_anti")
    return base.unionByName(fresh, allowMissingColumns=True)


def add_column_if_missing(df: DataFrame, name: str, dtype: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def sort_descending(df: DataFrame, column: str) -> DataFrame:
    """Greatest first, nulls before everything.

    The other columns break ties: the order is repeatable, and rows that share one
    value can be spread over several tasks.
    """
    return df.orderBy(F.col(column).desc_nulls_first(), *[c for c in df.columns if c != column])


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """First row with the key, as a table of at most one row."""
    return df.where(F.col(key) == F.lit(value)).limit(1)
