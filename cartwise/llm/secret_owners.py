"""Secret scan with the corpus-wide frequency of owners; DataFrame functions only.

Three patterns give the base spans of every text: assigned values, access keys and long hexadecimal runs. A fourth gives
further candidates, opaque runs of letters and digits, that stand in no base span. A candidate is known by the SHA-256 of its
value; values themselves are never written. For every hash the distinct owners and the distinct repositories
(each of one owner) are counted over the whole corpus. A value that more than ``Rules.most_owners`` owners have is an
``example``, copied from documentation. One that fewer have and that looks live (varied characters, no placeholder words) is ``live``,
the rest is ``weak``. Base spans always stay, with their status; opaque candidates become spans if they are live.

Matches are found whole: the gaps between them (``split``) and the matches themselves (``regexp_extract_all``) add up to their places,
by a running sum over the rows of a text's matches. Hashes that hold more than a thousandth of all spans, at most a thousand, meet
their counts in a broadcast; for the others a shuffle does, where no hash has more than that.

Defined results: a null text is empty; a null owner is one owner, a null repository one repository of its owner;
rows that repeat are counted once, as one repository, and each has its spans; a text without a match has no spans;
places are code points; other columns are ignored; an empty table gives an empty table. A text is whole in its row only, its matches are rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.session import materialise

# Kinds of base spans, what they match, and the characters that a match must have.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: A word of the method's own: long, and of letters and digits.
OPAQUE = r"[A-Za-z0-9_-]{16,}"
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("opaque", OPAQUE))
BASE = 3
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|redacted|your|xxxx|000000|123456|abcdef"
#: Part of all spans beyond which a hash is met in a broadcast.
HOT = 1000


@dataclass(frozen=True)
class Rules:
    """A value of more owners is an example; a live one has at least so many different characters."""

    most_owners: int = 3
    least_characters: int = 8


def looks_live(value: Column, rules: Rules) -> Column:
    """Enough different characters, a letter and a digit among them, and no placeholder word."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= rules.least_characters
    return varied & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)


def _matches(text: Column, number: int, rules: Rules) -> Column:
    """``kind, gap, long, hash, live, keep`` of every match in order; the gap lies before it."""
    kind, pattern = KINDS[number]

    def piece(x: Column) -> Column:
        value = F.regexp_extract(x.match, pattern, 2) if kind == "assign" else x.match
        keep = F.length(value) >= ASSIGN_LEAST if kind == "assign" else F.lit(True)
        live = looks_live(value, rules)
        if kind == "opaque":
            keep = live
        return F.struct(
            F.lit(number).alias("kind"),
            F.length(x.gap).alias("gap"),
            F.length(x.match).alias("long"),
            F.sha2(value, 256).alias("hash"),
            live.alias("live"),
            keep.alias("keep"),
        )

    # The last gap has no match behind it.
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    return F.when(text.rlike(pattern), F.transform(zipped, piece))


def candidates(documents: DataFrame, key: str, text: str, owner: str, repository: str, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """``key, row`` of every document, and ``row, owner, repository, kind, start, end, hash, live`` of its base spans and opaque candidates."""
    own = documents.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{owner}`").alias("owner"),
        F.col(f"`{repository}`").alias("repository"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    found = [_matches(F.col("text"), k, rules).alias(KINDS[k][0]) for k in range(len(KINDS))]
    scanned = materialise(own.select("key", "owner", "repository", "row", *found), "scanned")
    pieces = None
    for kind, _ in KINDS:
        one = scanned.select("row", "owner", "repository", F.posexplode(kind).alias("at", "m")).select("row", "owner", "repository", "at", "m.*")
        pieces = one if pieces is None else pieces.union(one)
    so_far = F.sum(F.col("gap").cast("long") + F.col("long")).over(W.partitionBy("row", "kind").orderBy("at"))
    placed = pieces.withColumn("end", so_far).withColumn("start", F.col("end") - F.col("long")).filter("keep")
    # An opaque candidate must stand apart from base spans: the last one that starts before it, and the first that starts behind.
    base = F.col("kind") < BASE
    order = W.partitionBy("row").orderBy("start", "kind")
    reached = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    ahead = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, W.unboundedFollowing))
    placed = placed.withColumns({"reached": reached, "ahead": ahead})
    apart = F.coalesce(F.col("reached") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True))
    placed = placed.filter(base | apart).select("row", "owner", "repository", "kind", "start", "end", "hash", "live")
    return scanned.select("key", "row"), materialise(placed, "candidates")


def frequencies(found: DataFrame) -> DataFrame:
    """``hash, spans, repositories, owners`` over the whole corpus; every step is combined before its shuffle."""
    by_repository = found.groupBy("hash", "owner", "repository").agg(F.count("*").alias("spans"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.sum("spans").alias("spans"), F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.sum("spans").alias("spans"), F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))


def with_frequencies(found: DataFrame) -> DataFrame:
    """``found`` with ``owners`` and ``repositories`` of its hash."""
    counts = materialise(frequencies(found), "frequencies")
    hot = (counts.agg(F.sum("spans")).first()[0] or 0) // HOT
    named = counts.select("hash", "owners", "repositories")
    often = F.broadcast(named.join(F.broadcast(counts.filter(F.col("spans") > hot).select("hash")), "hash", "left_semi"))
    rest = found.join(often.select("hash"), "hash", "left_anti").join(named, "hash")
    return found.join(often, "hash").select(rest.columns).union(rest)


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", rules: Rules = Rules()) -> DataFrame:
    """``<key>, spans`` for every row: ``kind, start, end, hash, owners, repositories, status``, in order of start and kind."""
    rows, found = candidates(documents, key, text, owner, repository, rules)
    status = F.when(F.col("owners") > rules.most_owners, "example").when(F.col("live"), "live").otherwise("weak")
    judged = with_frequencies(found).withColumn("status", status).filter((F.col("kind") < BASE) | (F.col("status") == "live"))
    names = F.array(*[F.lit(k) for k, _ in KINDS])
    span = F.struct("start", "kind", "end", "hash", "owners", "repositories", "status")
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    spans = spans.select(F.col("row").alias("of"), F.transform("spans", lambda s: F.struct(
        F.get(names, s.kind).alias("kind"), s.start.alias("start"), s.end.alias("end"), s.hash.alias("hash"),
        s.owners.alias("owners"), s.repositories.alias("repositories"), s.status.alias("status"),
    )).alias("spans"))
    kind = dict(spans.dtypes)["spans"]
    return rows.join(spans, F.col("row") == F.col("of"), "left").select(F.col("key").alias(key), F.coalesce("spans", F.array().cast(kind)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
