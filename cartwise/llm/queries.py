"""The corpus operators on the given tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import (
    chat_format,
    decontaminate,
    fill_middle,
    fuzzy_lines,
    language_id,
    merkle,
    ngram_join,
    piece_ids,
    pivots,
    quality,
    recompression,
    secret_owners,
    token_counts,
)
from cartwise.llm.arrow import bounded
from cartwise.session import materialise, ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(bounded(ready(spark)), folder)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- 2: chat formatting --------------------------------------------------------------------------

_CONTROL = " + ".join(
    f"(length(t) - length(replace(t, '{s}', ''))) / {len(s)}" for s in chat_format.TEMPLATE.control()
)
_MARKS = sum(len(s) for s in (chat_format.TEMPLATE.start, chat_format.TEMPLATE.body, chat_format.TEMPLATE.end)) + 1


@query(
    "op2_chat_formatting",
    f"""WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
    sized AS (SELECT *, length(t) + length(t) - length(replace(t, '\\', '')) + {_CONTROL} + length(role) + {_MARKS} AS chars FROM turns)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
        CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id""",
)
def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "'</s>[INST] ok [/INST]'"
    own = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, {said} AS text UNION ALL SELECT -7L, 1L, 'assistant', {said}")
    back = chat_format.read_back(chat_format.format_chats(rows.union(own), "conv_id"))
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


# --- 5: quality classifier -----------------------------------------------------------------------


def fold(key: str, folds: int):
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % folds


def quality_model(spark: SparkSession, folder: str) -> quality.Model:
    """Learned from the labelled rows outside fold 0 of 5."""
    labelled = table(spark, folder, "labels").filter(fold("doc_id", 5) != 0)
    return quality.train(table(spark, folder, "documents"), labelled)


QUALITY_LIMIT = 0.3


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score(texts, quality_model(spark, folder)).drop("text")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(True))
    predicted = (F.col("score") >= QUALITY_LIMIT).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


# --- 10: language identification -----------------------------------------------------------------


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    learned = documents.filter(F.col("lang").isNotNull() & (fold("doc_id", 4) != 2)).select("text", "lang")
    counts = materialise(language_id.count_grams(learned), "grams")
    filters = language_id.learn(counts)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(True))
    found = language_id.predict(documents.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


# --- 3: SentencePiece encoding and decoding ------------------------------------------------------


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counts = materialise(piece_ids.word_counts(documents), "words")
    encoded = piece_ids.encode(documents, piece_ids.segment_table(counts, model), model)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


# --- 4: token counts -----------------------------------------------------------------------------

TOKEN_LIMIT = 1024


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


# --- 7: benchmark decontamination ----------------------------------------------------------------

_WORDS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{decontaminate.WORD}')"


@query(
    "op7_decontamination",
    f"""WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    i AS (SELECT item_id, w, least(len(w), 10) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
    iw AS (SELECT item_id, size, array_to_string(w[s + 1 : s + size], ' ') AS win
        FROM (SELECT *, unnest(range(0, len(w) - size + 1)) AS s FROM i)),
    dw AS (SELECT doc_id, size, s, array_to_string(w[s + 1 : s + size], ' ') AS win
        FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS s FROM d, (SELECT DISTINCT size FROM i) WHERE len(w) >= size)),
    hit AS (SELECT doc_id, item_id, s, size FROM dw JOIN iw USING (size, win)),
    covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM hit) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


# --- 1: embedding near-duplicates ----------------------------------------------------------------


@query("op1_embedding_near_dedup")
def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding", "label", 0.98)


# --- 9: line dedup -------------------------------------------------------------------------------


@query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(documents, settings=fuzzy_lines.CORPUS).select(
        "doc_id",
        F.col("lines").cast("long").alias("n_lines"),
        F.col("lines_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


# --- 8: n-gram Jaccard join ----------------------------------------------------------------------


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op8_ngram_join",
    f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + least(5, len(w))], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(0, len(w) - least(5, len(w)) + 1)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
    m AS (SELECT doc_id, min(other) AS least_other FROM r GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(least_other, doc_id)) AS component_id
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
)
def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


# --- 6: substring dedup --------------------------------------------------------------------------


@query(
    "op6_substring_dedup",
    """WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    g AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 20], ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
    r AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM r),
    lost AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM d),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)""",
)
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return recompression.remove_repeats(documents).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


# --- 11: secret scans ----------------------------------------------------------------------------


def _spans_sql(number: int) -> str:
    """Matches of a kind with their places: marked, split at the marks, and lengths added up."""
    kind, pattern = secret_owners.KINDS[number]
    quoted = pattern.replace("'", "''")
    value = f"regexp_extract(m, '{quoted}', 2)" if kind == "assign" else "m"
    return f"""SELECT r, source, doc_id, {number} AS kind, stop - length(m) AS s, stop AS e, {value} AS v FROM (
        SELECT *, sum(length(piece) - (i > 0)::INT) OVER (PARTITION BY r ORDER BY i) - length(piece) + (i > 0)::INT + length(m) AS stop FROM (
            SELECT *, CASE WHEN i > 0 THEN string_split(piece, chr(57345))[1] END AS m FROM (
                SELECT r, source, doc_id, unnest(p) AS piece, unnest(range(0, len(p))) AS i FROM (
                    SELECT r, source, doc_id, string_split(regexp_replace(text, '({quoted})', chr(57344) || '\\1' || chr(57345), 'g'), chr(57344)) AS p FROM d)))) WHERE i > 0"""


_LIVE = f"""(len(list_distinct(string_split(v, ''))) >= {secret_owners.Rules.least_characters} AND regexp_matches(v, '[0-9]')
    AND regexp_matches(v, '[A-Za-z]') AND NOT regexp_matches(v, '{secret_owners.PLACEHOLDER}'))"""


@query(
    "op11_secret_scan",
    f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
    every AS ({" UNION ALL ".join(f"({_spans_sql(k)})" for k in range(4))}),
    judged AS (SELECT *, {_LIVE} AS live FROM every),
    base AS (SELECT * FROM judged WHERE kind < 3 AND (kind > 0 OR length(v) >= {secret_owners.ASSIGN_LEAST})),
    opaque AS (SELECT * FROM judged j WHERE kind = 3 AND live AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = j.r AND b.s < j.e AND j.s < b.e)),
    found AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
    owned AS (SELECT v, count(DISTINCT coalesce('1' || source, '0')) AS owners FROM found GROUP BY v),
    named AS (SELECT *, CASE WHEN owners > {secret_owners.Rules.most_owners} THEN 'example' WHEN live THEN 'live' ELSE 'weak' END AS status,
        ['assign', 'access', 'hex', 'opaque'][kind + 1] || ':' || s::BIGINT || ':' || e::BIGINT AS span FROM found JOIN owned USING (v)),
    kept AS (SELECT * FROM named WHERE kind < 3 OR status = 'live'),
    listed AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans,
        count(*) FILTER (status = 'live') AS n_live, count(*) FILTER (status = 'example') AS n_example FROM kept GROUP BY r)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
        coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
    FROM d LEFT JOIN listed USING (r)""",
)
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_owners.scan(table(spark, folder, "documents"))
    base = [kind for kind, _ in secret_owners.KINDS[: secret_owners.BASE]]

    def count(field: str, value: str):
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    return found.select(
        "doc_id",
        *[count("kind", kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_owners.listed(F.filter("spans", lambda s: s.kind.isin(base))), 256).alias("base_sha256"),
        secret_owners.listed(F.col("spans")).alias("spans"),
        *[count("status", status).alias(f"n_{status}") for status in ("live", "example")],
    )


# --- 12: fill in the middle ----------------------------------------------------------------------


@query(
    "op12_fill_middle",
    """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM p""",
)
def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    found = fill_middle.transform(table(spark, folder, "documents").select("doc_id", "text"))
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return found.select(
        *["doc_id", "n", "form", "prefix_chars", "middle_chars"],
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


# --- 13: Merkle manifest -------------------------------------------------------------------------

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf_sql(text: str) -> str:
    fields = [*[f"CAST({f} AS VARCHAR)" for f in FIELDS[:-1]], text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _tree_sql(name: str, nodes: str) -> str:
    """All nodes of the trees over ``nodes``, the runs they make, and the walk of every leaf up to its last node."""
    return f"""{name} AS (SELECT g, 0 AS level, i, h, m FROM {nodes} UNION ALL
        SELECT g, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value(CAST(ceil(m / 16) AS BIGINT)) FROM {name} WHERE m > 1 GROUP BY g, level, i // 16),
    {name}_runs AS (SELECT g, level, i // 16 AS p, list(h ORDER BY i) AS run FROM {name} WHERE m > 1 GROUP BY ALL)"""


def _walk_sql(name: str, tree: str, start: str) -> str:
    return f"""{name} AS (SELECT r, g, 0 AS level, i, t, proof FROM {start} UNION ALL
        SELECT r, g, level + 1, i // 16, sha256(array_to_string(run[1 : i % 16] || [t] || run[i % 16 + 2 :], '')),
            proof || array_to_string(run[1 : i % 16] || run[i % 16 + 2 :], '') FROM {name} JOIN {tree}_runs USING (g, level) WHERE p = i // 16),
    {name}_end AS (SELECT r, arg_max(t, level) AS t, arg_max(proof, level) AS proof FROM {name} GROUP BY r)"""


# DuckDB has no crc32.
_CRC = "SELECT list(list_reduce(range(8), lambda c, k : CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS crcs FROM range(256) t(i)"
_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c : CAST(ascii(c) AS BIGINT))"
_FIFTH = f"xor(list_reduce({_DIGITS}, lambda a, b : xor(a >> 8, crcs[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 5 = 0"
_CHANGED = f"CASE WHEN {_FIFTH} THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"


@query(
    "op13_merkle_manifest",
    f"""WITH RECURSIVE crc AS ({_CRC}),
    l AS (SELECT row_number() OVER () AS r, doc_id, coalesce('1' || source, '0') AS g, {_leaf_sql("text")} AS h, {_leaf_sql("changed")} AS t
        FROM (SELECT *, {_CHANGED} AS changed FROM documents, crc)),
    n AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, r) - 1 AS i, count(*) OVER (PARTITION BY g) AS m, '' AS proof FROM l),
    {_tree_sql("low", "n")},
    s AS (SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS m FROM low WHERE m = 1),
    {_tree_sql("high", "s")},
    {_walk_sql("up", "low", "n")},
    half AS (SELECT n.r, '' AS g, s.i, up_end.t, up_end.proof FROM n JOIN s ON s.name = n.g JOIN up_end ON up_end.r = n.r),
    {_walk_sql("top", "high", "half")}
    SELECT doc_id, n.h AS leaf, s.h AS subroot, high.h AS root, sha256(top_end.proof) AS proof_sha256, top_end.t AS folded_root, top_end.t = high.h AS verified
    FROM n JOIN s ON s.name = n.g JOIN top_end ON top_end.r = n.r JOIN high ON high.m = 1""",
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = F.when(fold("doc_id", 5) == 0, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    tampered = merkle.leaf([*[F.col(f) for f in FIELDS[:-1]], changed])
    found = merkle.manifest(documents, "doc_id", "source", FIELDS, others={"tampered": tampered})
    again = merkle.folded(F.col("tampered"), F.col("path"))
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
