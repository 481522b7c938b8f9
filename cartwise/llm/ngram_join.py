"""Similarity join of documents by the Jaccard similarity of their word n-grams.

The documents' n-gram sets are the rows of a sparse matrix, and overlaps of documents are entries of its product
with its transpose. The product is built over the necessary columns only. In an order of all columns,
two documents that are similar enough share a column among each one's first ``n - ceil(similarity n) + 1`` (the
prefix). The order is: columns with a hash in the lowest ``LOW`` of its range by number of documents and
hash, then the rest by hash. So only the lowest hashes of a document (and as many more as its prefix needs)
leave its task, their documents are counted, columns of one document take their places in the prefix and go, and
common columns, such as passages many documents share, fall behind it.

The product is worked off in blocks of documents that share a necessary column (:mod:`cartwise.llm.linking`): their whole sets
meet in one task, which adds up the overlaps over runs of columns and discards pairs below the bound that follows from
the two sizes. No pair leaves the task; a block returns its components.

The result is exact up to 64-bit hashes of n-grams. Documents with equal sets are one entry.

Defined results: texts without words, null ones included, have no n-gram and link with nothing; a text of fewer
words is one n-gram; rows that share an id are one node; rows with a null id link with nothing; other columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.bounded import small
from cartwise.llm.components import components
from cartwise.llm.linking import block_links, leader_groups, similar_sets
from cartwise.llm.slabs import byte_texts, mixed
from cartwise.llm.word_runs import ngrams, word_arrays
from cartwise.session import materialise

WORDS = 5
#: Percent of the union that the intersection must be.
PERCENT = 75
LOW = 0.3
_EDGE = np.uint64(int(LOW * 2**48))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sets(texts: list[bytes], words: int) -> Iterator[tuple[int, np.ndarray]]:
    for number, own in word_arrays(texts, lower=True):
        yield number, np.unique(ngrams(own, words))


def described(documents: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """``id, n, d, e, emitted, columns``: set size, two digests, and the lowest columns, sorted.

    ``columns`` is null for a row without an id, and for a text whose set came before in the same batch under an id.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, columns, seen = [], [], [], set()
            named = batch.column("id").is_valid().to_pylist()
            for i, own in _sets(byte_texts(batch.column("text")), words):
                spread = mixed(own + np.uint64(7))
                digest = (int(spread.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mixed(spread))) if len(own) else 0)
                n.append(len(own))
                digests.append(digest)
                if not len(own) or not named[i] or digest in seen:
                    columns.append(None)
                    continue
                seen.add(digest)
                short = np.sort(own >> np.uint64(16))
                columns.append(short[: max(int(np.searchsorted(short, _EDGE)), prefix_length(len(own), percent))].astype(np.int64))
            both = np.array(digests, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            arrays = [pa.array(n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(columns, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", "n", "d", "e", "columns"])

    own = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return own.mapInArrow(rows, "id long, n long, d long, e long, columns array<long>")


def necessary(entries: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``key, node``: columns within the prefixes of the documents, where another document has them too."""
    columns = entries.filter(F.col("columns").isNotNull() & F.col("id").isNotNull())
    sent = columns.select("id", "n", F.size("columns").alias("sent"), F.explode("columns").alias("key"))
    counts = sent.groupBy("key").agg(F.count("*").alias("documents")).filter("documents > 1")
    shared = materialise(sent.join(counts, "key"), "columns")
    high = F.col("key") >= int(_EDGE)
    order = [high, F.when(high, 0).otherwise(F.col("documents")), F.col("key")]
    # A document's own columns only: a set is the largest group here.
    by = W.partitionBy("id")
    ranked = shared.withColumn("place", F.row_number().over(by.orderBy(*order))).withColumn("held", F.count("*").over(by))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    inside = ranked.filter(F.col("place") <= prefix - (F.col("sent") - F.col("held"))).select("id", "key")
    # Each set once, however many batches sent it.
    named = columns.select("id", "d", "e").join(classes.select("d", "e", F.col("id").alias("node")), ["d", "e"])
    return inside.join(named.select("id", "node"), "id").select("key", "node").distinct()


def similar_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``<key>, n_shingles, component_id`` for every row: set size and the smallest id reachable by links."""
    entries = materialise(described(documents, key, text, words, percent), "entries")
    classes = entries.filter("n > 0 AND id IS NOT NULL").groupBy("d", "e").agg(F.min("id").alias("id"), F.max("n").alias("n"))
    classes = materialise(classes, "classes")
    groups = materialise(leader_groups(materialise(necessary(entries, classes, percent), "prefixes")), "groups")
    nodes = materialise(groups.select(F.col("node").alias("id")).distinct(), "nodes")
    sets = materialise(_whole_sets(documents, small(nodes), key, text, words), "sets")

    def similar(own: list[pa.Array], side: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        columns = np.concatenate([x.flatten().to_numpy() for x in own])
        return similar_sets(columns, np.concatenate([x.value_lengths().to_numpy() for x in own]), side, block, percent)

    links = materialise(block_links(groups, sets, similar), "found")
    reached = components(links)
    named = classes.join(reached, classes.id == reached.node, "left")
    named = named.select("d", "e", F.coalesce("component", "id").alias("component"))
    own = entries.select("id", "n", *[F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col(c)).alias(c) for c in ("d", "e")])
    return own.join(named, ["d", "e"], "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def _whole_sets(documents: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``node, weight, own``: all n-grams of the documents wanted, and their number; an id that has several texts has as many rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # a repeated row is sent once for each task
        for batch in batches:
            ids, own = [], []
            for key, (_, found) in zip(batch.column("id").to_pylist(), _sets(byte_texts(batch.column("text")), words)):
                digest = key, len(found), int(found.sum(dtype=np.uint64))
                if digest not in seen:
                    seen.add(digest)
                    ids.append(key)
                    own.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(own, pa.list_(pa.int64()))], ["id", "own"])

    own = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(wanted, "id", "left_semi")
    schema = T.StructType().add("id", T.LongType()).add("own", T.ArrayType(T.LongType()))
    return own.mapInArrow(rows, schema).select(F.col("id").alias("node"), F.size("own").cast("long").alias("weight"), "own")
