"""Benchmark decontamination as a prefix-filtered set join; DataFrame functions only.

A benchmark item is cut into windows of ``WINDOW`` words (an item of fewer words is one window), a window into
overlapping shingles of ``SHINGLE`` words (fewer in shorter windows). One scan of the documents keeps the
places of shingles that the benchmark has. Their counts over all documents order a window's shingles by rarity.
Containment is whole, so a window's necessary prefix is its rarest shingle alone: only the places of that one
are candidates. Its offset in the window gives the window's place in the document (positional bound), which
must lie inside the document (length bound); then every shingle of the window must stand at its place.

Shingles are compared by 64-bit hashes; a full window agrees in eight of them at consecutive places.

The benchmark's shingles are broadcast if there are at most a million of them, counted first;
more are joined by a shuffle. Nothing else is broadcast by hint.

Defined results: a null text has no words; documents without words, and all documents if the benchmark
has no words, have no hits; documents are told apart by key and text, so repeated rows get the same result
each, also under a null key; an item with a null id is named ``null``; items that share an id count once;
other columns, whatever their names, are ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.bounded import small
from cartwise.session import materialise

WINDOW = 10
SHINGLE = 3
#: Everything but digits, small letters and what is beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), BETWEEN), "")


def shingles(own: Column, size: int) -> Column:
    """Hashes of ``size`` consecutive words at every place of the words ``own``."""
    last = F.size(own) - F.lit(size)
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    return F.transform(places, lambda i: F.xxhash64(F.lit(size), *[F.get(own, i + j) for j in range(size)]))


def windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``item, window, length, size, own``: an item's windows, named by their words, with their shingles in order."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), words(F.col(text)).alias("w"))
    items = items.filter(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(WINDOW)))
    cut = items.select("item", "length", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1)).alias("at"))
    cut = cut.select("item", "length", F.slice("w", F.col("at"), F.col("length")).alias("w"))
    cut = cut.withColumn("size", F.least(F.col("length"), F.lit(SHINGLE)))
    own = F.when(F.col("size") == 1, shingles(F.col("w"), 1)).when(F.col("size") == 2, shingles(F.col("w"), 2))
    return cut.select("item", F.md5(F.array_join("w", " ")).alias("window"), "length", "size", own.otherwise(shingles(F.col("w"), SHINGLE)).alias("own"))


def _documents(documents: DataFrame, key: str, text: str) -> DataFrame:
    return documents.select(F.col(key).alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))


def places(documents: DataFrame, wanted: DataFrame, sizes: list[int], key: str, text: str) -> DataFrame:
    """``k, t, n, at, h``: where documents have the shingles ``wanted`` (column ``h``); n is the number of words."""
    split = _documents(documents, key, text).select("k", "t", words(F.col("text")).alias("w"))
    found = None
    for size in sizes:
        hashed = split.select("k", "t", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"), size)).alias("at", "h"))
        here = hashed.join(wanted, "h").select("k", "t", "n", "at", "h")
        found = here if found is None else found.union(here)
    return found.distinct()


def occurring(documents: DataFrame, benchmark: DataFrame, key: str, item: str, text: str) -> DataFrame:
    """``k, t, at, length, item``: every occurrence of an item's window in a document."""
    cut = materialise(windows(benchmark, item, text), "windows")
    sizes = sorted(r.size for r in cut.select("size").distinct().collect())
    wanted = materialise(cut.select(F.explode("own").alias("h")).distinct(), "shingles")
    if not sizes:
        kinds = {"t": "bigint", "at": "int", "length": "int", "item": "string"}
        return documents.select(F.col(key).alias("k"), *[F.lit(None).cast(v).alias(c) for c, v in kinds.items()]).limit(0)
    found = materialise(places(documents, small(wanted), sizes, key, text), "places")
    counted = found.groupBy("h").agg(F.count("*").alias("count"))
    each = cut.dropDuplicates(["window"]).select("window", "length", F.size("own").alias("of"), F.posexplode("own").alias("offset", "h"))
    each = materialise(each.join(counted, "h", "left"), "offsets")
    # A window with a shingle that no document has cannot occur; it has no prefix.
    order = F.struct(F.coalesce("count", F.lit(0)).alias("count"), "offset", "h")
    prefix = each.groupBy("window", "length", "of").agg(F.min(order).alias("first")).filter("first.count > 0")
    prefix = prefix.select("window", "length", "of", F.col("first.offset").alias("offset"), F.col("first.h").alias("h"))
    candidates = found.join(prefix, "h").withColumn("start", F.col("at") - F.col("offset"))
    candidates = candidates.filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n")))
    candidates = candidates.select("k", "t", "start", "window", "length", "of")
    expected = candidates.join(each.select("window", "offset", "h"), "window")
    expected = expected.withColumn("at", F.col("start") + F.col("offset"))
    same = [expected.k.eqNullSafe(found.k), expected.t == found.t, expected["at"] == found["at"], expected.h == found.h]
    agreeing = expected.join(found, same, "left_semi").groupBy("k", "t", "start", "window", "length", "of").count()
    whole = agreeing.filter(F.col("count") == F.col("of"))
    owners = cut.select("window", "item").distinct()
    return whole.join(owners, "window").select("k", "t", F.col("start").alias("at"), "length", "item")


def contamination(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``<key>, text_hash, n_words, n_hit, items, contaminated`` for every document.

    ``n_hit`` counts the words inside occurrences of windows; ``items`` lists the occurring items by
    name, sorted. ``text_hash`` is ``xxhash64`` of the text, which with the key tells documents apart.
    """
    found = materialise(occurring(documents, benchmark, key, item, text), "occurrences")
    spans = found.select("k", "t", "at", "length").distinct()
    covered = spans.select("k", "t", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).alias("at")).distinct()
    hit = covered.groupBy("k", "t").agg(F.count("*").alias("n_hit"))
    named = found.select("k", "t", "item").distinct().groupBy("k", "t").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = hit.alias("a").join(named.alias("b"), F.col("a.k").eqNullSafe(F.col("b.k")) & (F.col("a.t") == F.col("b.t")))
    hits = hits.select(F.col("a.k").alias("hk"), F.col("a.t").alias("ht"), "n_hit", "items")
    counts = documents.select(F.col(key).alias("k"), F.xxhash64(text).alias("t"), F.regexp_count(lowered(F.col(text)), F.lit(WORD)).alias("n"))
    all_rows = counts.join(hits, F.col("k").eqNullSafe(F.col("hk")) & (F.col("t") == F.col("ht")), "left")
    return all_rows.select(
        F.col("k").alias(key),
        F.col("t").alias("text_hash"),
        F.col("n").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
