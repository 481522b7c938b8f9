"""Joins in which a few keys hold much of a side.

A frequent-items sketch of each side, merged over its tasks, names the keys that hold more than a share of the rows; all
others join as usual. The rows of hot keys are counted on the other side. Where those are few, they are broadcast, so the
many stay where they are. A key with many rows on both sides forms a grid: left rows are dealt over the grid's rows, right
ones over its columns, each is copied along the other way, and every pair meets in one cell. Sketches and counts read
the key columns alone, and a table without hot keys is joined as if they had not been asked for.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Salts a key gets for each ``share`` of the rows that it holds; more than one lets them spread evenly over tasks.
PIECES = 4
#: Keys tracked by a sketch for each one that can be hot; the error of a count is then below ``share`` / 4.
TRACKED = 16
#: A sketch of the smallest share holds 80,000 keys.
LEAST_SHARE = 1 / 5_000
#: Sketches left after the first of two merges.
MERGED = 256
#: Rows of hot keys, counted before, that are broadcast at most.
MOST_BROADCAST = 100_000
#: Most equal rows that travel as one.
MOST_COPIES = 65_536


def default_share(spark: SparkSession) -> float:
    """One shuffle partition's part of the rows."""
    partitions = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    partitions = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_SHARE, 1 / max(8, partitions))


def frequent_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys that hold ``share`` of the rows or more: (key, n_rows, slots).

    No such key is missing. A count is too high by at most a quarter of ``share``, so a few that hold less can be
    among them. Null is no key. At most 2 / ``share`` rows, whatever the table holds; no ``share`` is below ``LEAST_SHARE``.
    """
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"share is between {LEAST_SHARE} and 1")
    most, tracked = math.ceil(2 / share), math.ceil(TRACKED / share)
    keys = df.select(F.col(key).alias("_key")).where("_key IS NOT NULL")
    # Sketches of tasks merge in two steps, so no task takes in one of every other task.
    parts = keys.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGED)).alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("_sketch")
    )
    # A group rather than a total: a table without keys has no sketch to read.
    whole = parts.groupBy(F.lit(0).alias("_all")).agg(
        F.sum("_n").alias("_total"), F.expr("approx_top_k_combine(_sketch)").alias("_sketch")
    )
    items = whole.select("_total", F.expr(f"inline(approx_top_k_estimate(_sketch, {most}))"))
    held = items.where(F.col("count") >= F.col("_total") * share)
    slots = F.ceil(F.col("count") * PIECES / (F.col("_total") * share)).cast("int")
    return held.select(F.col("item").alias(key), F.col("count").alias("n_rows"), slots.alias("slots"))


def hot_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    share: float | None = None,
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, key, how)``, inner or left, with the rows of hot keys spread over many tasks.

    ``left_keys`` and ``right_keys`` are tables whose keys are distributed like those of a side that is itself the
    result of a join; the sketch then does not compute it. ``share`` is the part of a side's rows from which a key is
    hot, by default one shuffle partition's; the key has one type on both sides. Rows with a null key match
    nothing and are not shuffled. Rows that are equal in all columns are dealt as counts, so they spread as well, and
    dealing depends on the values alone: a task that is run again deals them alike. Of a key that is hot on both sides,
    columns must be of types that can be grouped by, and -0.0 becomes 0.0.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    spark = left.sparkSession
    share = share or default_share(spark)
    columns = [key, *[c for c in left.columns if c != key], *[c for c in right.columns if c != key]]
    sides = [(left if left_keys is None else left_keys, "_rows"), (right if right_keys is None else right_keys, "_columns")]
    sketches = [frequent_keys(df, key, share).select(key, F.col("slots").alias(name)) for df, name in sides]
    # Both sketches are bounded by the share, and so is what is brought here: 4 / share small rows.
    hot = sketches[0].join(sketches[1], key, "full").fillna(1, ["_rows", "_columns"]).collect()
    schema = left.select(key).schema.add("_rows", "integer").add("_columns", "integer")

    def listed(keys: set) -> DataFrame:
        return F.broadcast(spark.createDataFrame([r for r in hot if r[key] in keys], schema))

    def of(df: DataFrame, keys: set, kind: str = "left_semi") -> DataFrame:
        return df.join(listed(keys).select(key), key, kind) if keys else df

    keys = {r[key] for r in hot}
    few_right = _few(of(right, keys), keys, key)
    # Rows without a partner are kept on the left, so only an inner join can broadcast that side; a result is not counted.
    few_left = _few(of(left, keys - few_right), keys - few_right, key) if how == "inner" and left_keys is None else set()
    both = keys - few_right - few_left
    keyed, partners = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    found = [of(keyed, keys, "left_anti").join(of(partners, keys, "left_anti"), key, how)]
    if few_right:
        found.append(of(left, few_right).join(F.broadcast(of(right, few_right)), key, how))
    if few_left:
        found.append(of(right, few_left).join(F.broadcast(of(left, few_left)), key))
    if both:
        # These keys have rows on the right, so no row of the left is without a partner.
        grid = listed(both)
        dealt = _dealt(left, grid, key, "_rows", "_columns").withColumnRenamed("_copies", "_copies_left")
        other = _dealt(right, grid, key, "_columns", "_rows").withColumnRenamed("_copies", "_copies_right")
        found.append(_repeated(dealt.join(other, [key, "_rows", "_columns"]), "_copies_left", "_copies_right"))
    result = reduce(DataFrame.unionByName, [df.select(*columns) for df in found])
    if how == "inner":
        return result
    return result.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


def _few(held: DataFrame, keys: set, key: str) -> set:
    """Keys, those with the fewest rows first, whose rows in ``held`` are ``MOST_BROADCAST`` at most together."""
    if not keys:
        return set()
    counts = {k: 0 for k in keys} | {r[key]: r["n"] for r in held.groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, few = 0, set()
    for k, n in sorted(counts.items(), key=lambda c: c[1]):
        total += n
        if total > MOST_BROADCAST:
            break
        few.add(k)
    return few


def _dealt(df: DataFrame, grid: DataFrame, key: str, own: str, other: str) -> DataFrame:
    """Rows of hot keys, each in one of its ``own`` slots and copied to every one of the ``other`` ones."""
    # Equal rows become counts of at most a piece's size, which combine before the shuffle.
    names = df.columns
    counted = df.join(grid.select(key), key, "left_semi").groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("_n"))
    sized = counted.join(grid, key)
    pieces = F.least(F.col("_n"), F.greatest(F.col(own).cast("long"), F.ceil(F.col("_n") / MOST_COPIES)))
    piece = sized.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    copies = F.floor((F.col("_n") + F.col("_piece")) / pieces).cast("long")
    first = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.col(own))
    slot = F.pmod(first + F.col("_piece"), F.col(own)).cast("int")
    slots = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    return piece.withColumns({"_copies": copies, own: slot}).withColumn(other, slots).drop("_n", "_piece")


def _repeated(df: DataFrame, *copies: str) -> DataFrame:
    """Each row as often as the product of ``copies`` says."""
    for column in copies:
        df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(column)))).drop("_copy", column)
    return df
