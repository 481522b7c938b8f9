"""The registered corpus queries on the smallest tables: against SQL, the tokenizers' own libraries, or held-out rows."""

import hashlib
import struct
import zlib

import pytest
import sentencepiece
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from compare import connect, rows

FOLDER = "/root/testdata/sf0.001"
ORACLES = {n: q for n, q in entry_points.oracle_sql().items() if n not in entry_points.ORACLES}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def found(spark, name):
    return {r.doc_id: r for r in entry_points.queries()[name](spark, FOLDER).collect()}


def crc(key) -> int:
    return zlib.crc32(str(key).encode())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    own = entry_points.queries()[name](spark, FOLDER).toPandas()
    expected = connect(FOLDER).execute(ORACLES[name]).df()
    assert sorted(own.columns) == sorted(expected.columns)
    assert rows(own) == rows(expected)


def test_one_query_for_each_operator():
    names = set(entry_points.queries()) - set(entry_points.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_pieces_as_the_library_has_them(spark, texts):
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for key, row in found(spark, "op3_sentencepiece").items():
        ids = own.encode(texts[key], add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(own.decode(ids).encode()).hexdigest()


def test_tokens_as_the_library_counts_them(spark, texts):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key, row in found(spark, "op4_token_counts").items():
        count = len(own.encode(texts[key], add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[key].encode()), count, count > 1024)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    scored = {r.doc_id: r for r in entry_points.queries()["op5_quality_classifier"](spark, folder).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    assert all(r.held_out == (crc(k) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for k, r in scored.items())
    held = [(scored[k].predicted, y) for k, y in labels if crc(k) % 5 == 0]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_languages_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    named = {r.doc_id: r for r in entry_points.queries()["op10_language_id"](spark, folder).collect()}
    langs = [(r.doc_id, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert all(r.held_out == (crc(k) % 4 == 2) and 0 <= r.score <= 1 for k, r in named.items())
    held = [(named[k].lang_pred, lang) for k, lang in langs if crc(k) % 4 == 2]
    assert sum(p == lang for p, lang in held) >= 0.97 * len(held)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    assert len(corpus_pipeline.STAGES) == 5
    result = corpus_pipeline.run(spark, FOLDER)
    kept = {r.doc_id for r in result.collect()}
    assert 0 < len(kept) < sizes[0]
    first = corpus_pipeline.STAGES[0][1](spark, docs, FOLDER)
    assert first.columns == columns
    contaminated = {r.doc_id for r in entry_points.queries()["op7_decontamination"](spark, FOLDER).collect() if r.contaminated}
    lines = {r.doc_id for r in entry_points.queries()["op9_line_dedup"](spark, FOLDER).collect() if r.n_removed}
    assert not kept & (contaminated - lines)  # a line taken out before can have held the passage
