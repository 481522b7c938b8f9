"""Exact quantiles of large columns, whole or by group, in two reads of the data.

The built-in exact percentile merges a map of every distinct value into one task. Here the first read
merges rank sketches (Greenwald and Khanna, Spark's ``percentile_approx``), whose stated error brackets
each wanted rank. The second counts the values below each bracket and, by value, those inside. A count
says whether a bracket holds its ranks; one that does not is widened to all values. What was
counted inside is a small table: where it has more than ``BUCKETS`` values for a bracket, passes
over that table alone narrow it. Groups of at most ``BUCKETS`` values have no sketch: a count by group finds them, and they are sorted as they are. ``approximate_quantiles`` is the first read by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.session import materialise

#: Values of a bracket that one task may sort; groups of as many values are a bracket as they are.
BUCKETS = 4096
#: A sketch's ranks are off by at most a share of 1 / ACCURACY of the values.
ACCURACY = 10_000
#: Share of the values that a bracket reaches to either side: the error, and more than one rank beyond ``BUCKETS`` values.
REACH = 4 / ACCURACY
INFINITY = float("inf")
GROUP = ["g", "c", "b"]


def _values(df: DataFrame, columns: list[str], by: str | None) -> DataFrame:
    group = F.col(by) if by else F.lit(None).cast("string")
    values = df.select(group.alias("g"), *[F.col(c).cast("double").alias(c) for c in columns])
    return values.unpivot(["g"], columns, "c", "x").where("x IS NOT NULL AND NOT isnan(x)")


def approximate_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], error: float, by: str | None = None) -> DataFrame:
    """``g, c, p, value``: values of the data whose rank is off by at most ``error`` x the number of values, in one read.

    Nulls, NaN, groups and places are as in ``quantile_table``.
    """
    if not 0 < error < 1:
        raise ValueError("an error is a share between 0 and 1")
    accuracy = math.ceil(1 / error)
    found = _values(df, columns, by).groupBy("g", "c").agg(F.percentile_approx("x", [float(p) for p in probabilities], accuracy).alias("found"))
    return found.select("g", "c", F.posexplode("found").alias("p", "value"))


def quantile_table(df: DataFrame, columns: list[str], probabilities: list[float], by: str | None = None) -> DataFrame:
    """``g, c, p, value``: quantiles with linear interpolation by group, column name and place of the probability.

    Nulls and NaN are skipped; a group or column without values has no row. ``g`` is null without ``by``.
    Infinities are values like others. ``df`` is read twice, by group once more to count; hand in a written table.
    """
    if by is None:
        return _of_large(_values(df, columns, by), probabilities)
    counts = df.groupBy(F.col(by).alias("group of")).agg(*[F.count(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(c) for c in columns])
    large = counts.filter(F.greatest(*columns, F.lit(0)) > BUCKETS).select("group of")
    large = materialise(large, "large-groups")  # a row for BUCKETS rows at least
    if large.isEmpty():
        return _of_small(_values(df, columns, by), probabilities)
    same = F.col(by).eqNullSafe(F.col("group of"))
    small = _of_small(_values(df.join(large, same, "left_anti"), columns, by), probabilities)
    return small.unionByName(_of_large(_values(df.join(large, same, "left_semi"), columns, by), probabilities))


def _asked(probabilities: list[float]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("p"), F.lit(float(p)).alias("share")) for i, p in enumerate(probabilities)])


def _between(low: Column, high: Column, position: Column) -> Column:
    """The quantile at a position between the values of the ranks beside it."""
    return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))


def _of_small(values: DataFrame, probabilities: list[float]) -> DataFrame:
    """``g, c, p, value`` of groups of at most ``BUCKETS`` values: each is sorted by one task."""
    group = W.partitionBy("g", "c")
    # 0.0 and -0.0 are one value.
    ranked = values.withColumn("x", F.col("x") + F.lit(0.0))
    ranked = ranked.withColumns({"rank": F.row_number().over(group.orderBy("x")) - 1, "n": F.count("x").over(group)})
    places = F.transform(_asked(probabilities), lambda a: F.struct(a.p.alias("p"), (a.share * (F.col("n") - 1)).alias("position")))
    beside = F.filter(places, lambda a: F.col("rank").between(F.floor(a.position), F.ceil(a.position)))
    rows = ranked.select("g", "c", "x", F.explode(beside).alias("a"))
    both = rows.groupBy("g", "c", F.col("a.p").alias("p"), F.col("a.position").alias("position")).agg(F.min("x").alias("low"), F.max("x").alias("high"))
    return both.select("g", "c", "p", _between(F.col("low"), F.col("high"), F.col("position")).alias("value"))


def _of_large(values: DataFrame, probabilities: list[float]) -> DataFrame:
    """``g, c, p, value`` by sketches and brackets, for groups of any size."""
    ends = [min(1.0, max(0.0, p + side)) for p in probabilities for side in (-REACH, REACH)]
    sketched = values.groupBy("g", "c").agg(
        F.count("x").alias("n"),
        F.min("x").alias("least"),
        F.max("x").alias("most"),
        F.percentile_approx("x", ends, ACCURACY).alias("ends"),
    )
    asks = sketched.withColumn("ask", F.explode(_asked(probabilities))).withColumn("position", F.col("ask.share") * (F.col("n") - 1))
    few = F.col("n") <= BUCKETS
    low = F.when(few | (F.col("ask.share") <= REACH), F.col("least")).otherwise(F.element_at("ends", 2 * F.col("ask.p") + 1))
    high = F.when(few | (F.col("ask.share") >= 1 - REACH), F.col("most")).otherwise(F.element_at("ends", 2 * F.col("ask.p") + 2))
    ranks = F.array_distinct(F.array(F.floor("position"), F.ceil("position")))
    asks = asks.select(
        "g", "c", F.col("ask.p").alias("p"), F.when(few, -1).otherwise(F.col("ask.p")).alias("b"),
        "position", F.explode(ranks).alias("rank"), low.alias("low"), high.alias("high"), "least", "most",
    )
    asks = materialise(asks, "ranks")
    while True:
        counted = materialise(_counted(values, asks.select(*GROUP, "low", "high").distinct()), "inside")
        placed = materialise(_placed(counted, asks), "brackets")
        state = placed.agg(F.count_if("missed").alias("missed"), F.max("distinct").alias("distinct")).first()
        if not state.missed:
            break
        wide = placed.filter("missed").select(*[F.col(c).alias(f"w_{c}") for c in GROUP]).distinct()
        same = F.col("g").eqNullSafe(F.col("w_g")) & (F.col("c") == F.col("w_c")) & (F.col("b") == F.col("w_b"))
        widened = asks.join(wide, same, "left")
        for end, limit in (("low", "least"), ("high", "most")):
            widened = widened.withColumn(end, F.when(F.col("w_b").isNotNull(), F.col(limit)).otherwise(F.col(end)))
        asks = materialise(widened.drop("w_g", "w_c", "w_b"), "ranks")
    known = placed.filter("value IS NOT NULL").select(*GROUP, "rank", "value")
    rest = placed.filter("value IS NULL").select(*GROUP, "rank", "low", "high", "below").distinct()
    most = state.distinct or 0
    while most > BUCKETS:
        narrowed = materialise(_narrowed(counted, rest), "brackets")
        rest, most = narrowed.drop("distinct"), narrowed.agg(F.max("distinct")).first()[0] or 0
    closed = known.distinct().unionByName(_sorted(counted, rest))
    found = asks.alias("a").join(closed.alias("v"), _same("a", "v") & (F.col("a.rank") == F.col("v.rank")))
    both = found.groupBy("a.g", "a.c", "a.p", "a.position").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return both.select("g", "c", "p", _between(F.col("low"), F.col("high"), F.col("position")).alias("value"))


def _same(left: str, right: str, names: tuple[str, ...] = ("c", "b")) -> Column:
    found = F.col(f"{left}.g").eqNullSafe(F.col(f"{right}.g"))
    for name in names:
        found = found & (F.col(f"{left}.{name}") == F.col(f"{right}.{name}"))
    return found


def _counted(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """``g, c, b, x, m``: how many rows have each value inside a bracket; x is null for all below it."""
    both = values.alias("v").join(brackets.alias("b"), _same("v", "b", ("c",)) & (F.col("v.x") <= F.col("b.high")))
    # 0.0 and -0.0 are one value.
    inside = F.when(F.col("x") >= F.col("b.low"), F.col("x") + F.lit(0.0)).alias("x")
    return both.groupBy("v.g", "v.c", "b.b", inside).agg(F.count("*").alias("m"))


def _placed(counted: DataFrame, asks: DataFrame) -> DataFrame:
    """Every rank with its bracket between finite values and the rows below; an infinite value is known at once."""
    finite = F.when(F.abs("x") != INFINITY, F.col("x"))

    def rows(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("m"))), F.lit(0))

    sums = counted.groupBy(*GROUP).agg(
        rows(F.col("x").isNull()).alias("under"),
        rows(F.col("x").isNotNull()).alias("inside"),
        rows(F.col("x") == -INFINITY).alias("first"),
        rows(F.col("x") == INFINITY).alias("last"),
        F.count(finite).alias("distinct"),
        F.min(finite).alias("low"),
        F.max(finite).alias("high"),
    )
    both = asks.drop("low", "high").alias("a").join(sums.alias("s"), _same("a", "s"))
    below, upto = F.col("under") + F.col("first"), F.col("under") + F.col("inside")
    value = F.when(F.col("rank") < below, -INFINITY).when(F.col("rank") >= upto - F.col("last"), INFINITY).when(F.col("low") == F.col("high"), F.col("low"))
    missed = (F.col("rank") < F.col("under")) | (F.col("rank") >= upto)
    return both.select("a.g", "a.c", "a.b", "rank", "low", "high", below.alias("below"), "distinct", value.alias("value"), missed.alias("missed"))


def _within(counted: DataFrame, ranks: DataFrame) -> DataFrame:
    brackets = ranks.select(*GROUP, "low", "high").distinct()
    return counted.alias("v").join(brackets.alias("b"), _same("v", "b") & F.col("v.x").between(F.col("b.low"), F.col("b.high")))


def _sorted(counted: DataFrame, ranks: DataFrame) -> DataFrame:
    """The value at every rank; a bracket holds at most ``BUCKETS`` values."""
    rows = _within(counted, ranks).select("v.g", "v.c", "v.b", "x", "m", F.col("b.low").alias("of"))
    before = F.sum("m").over(W.partitionBy(*GROUP, "of").orderBy("x")) - F.col("m")
    rows = rows.withColumn("before", before)
    found = ranks.alias("r").join(rows.alias("k"), _same("r", "k") & (F.col("r.low") == F.col("k.of")))
    offset = F.col("rank") - F.col("below") - F.col("before")
    return found.filter((offset >= 0) & (offset < F.col("m"))).select("r.g", "r.c", "r.b", "rank", F.col("x").alias("value"))


def _narrowed(counted: DataFrame, ranks: DataFrame) -> DataFrame:
    """Every rank with the bucket that holds it: ends are values, so each pass leaves out one value at least."""
    width = F.col("b.high") - F.col("b.low")
    # Halved where the width overflows; a bracket of one value has one bucket.
    place = F.when(width == 0, 0.0).when(width < INFINITY, F.try_divide(F.col("x") - F.col("b.low"), width)).otherwise(
        F.try_divide(F.col("x") / 2 - F.col("b.low") / 2, F.col("b.high") / 2 - F.col("b.low") / 2)
    )
    bucket = F.least(F.floor(place * BUCKETS), F.lit(BUCKETS - 1)).alias("bucket")
    buckets = _within(counted, ranks).groupBy("v.g", "v.c", "v.b", F.col("b.low").alias("of"), bucket)
    buckets = buckets.agg(F.sum("m").alias("m"), F.count("x").alias("distinct"), F.min("x").alias("low"), F.max("x").alias("high"))
    # At most BUCKETS rows of one bracket.
    before = F.sum("m").over(W.partitionBy(*GROUP, "of").orderBy("bucket")) - F.col("m")
    buckets = buckets.withColumn("before", before)
    found = ranks.alias("r").join(buckets.alias("k"), _same("r", "k") & (F.col("r.low") == F.col("k.of")))
    offset = F.col("rank") - F.col("below") - F.col("before")
    found = found.filter((offset >= 0) & (offset < F.col("m")))
    return found.select("r.g", "r.c", "r.b", "rank", "k.low", "k.high", (F.col("below") + F.col("before")).alias("below"), "distinct")


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float]]:
    """Column -> value per probability, over all rows; a column without values is left out."""
    rows = quantile_table(df, columns, probabilities).collect()  # columns x probabilities
    found: dict[str, list[float]] = {r.c: [math.nan] * len(probabilities) for r in rows}
    for r in rows:
        found[r.c][r.p] = r.value
    return found
