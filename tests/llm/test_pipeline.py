"""Every stage of the pipeline against a plain Python version on its predecessor's output."""

import re
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry_points
import corpus_pipeline
from test_text_operators import all_pairs_removed, groups

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark):
    """The rows before the first stage and after every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = stage(spark, docs, FOLDER)
        assert number == 4 or rows.columns == docs.columns
        found.append(rows.collect())
        if number < 4:
            docs = spark.createDataFrame(found[-1], docs.schema)
    return found


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_quality_stage(spark, outputs):
    kept = {r.doc_id for r in entry_points.queries()["op5_quality_classifier"](spark, FOLDER).collect() if r.predicted}
    assert texts(outputs[1]) == {k: t for k, t in texts(outputs[0]).items() if k in kept}
    assert 0 < len(kept) < len(outputs[0])


def test_lines_stage(outputs):
    before, after = texts(outputs[1]), texts(outputs[2])
    gone = defaultdict(set)
    for k, at in all_pairs_removed(before):
        gone[k].add(at)
    expected = {k: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k]) for k, t in before.items()}
    # MinHash may lose a link at the threshold.
    assert after.keys() == expected.keys() and sum(after[k] != expected[k] for k in after) <= 0.01 * len(after)
    assert all(r.n_chars == len(r.text) for r in outputs[2])


def test_similar_stage(outputs):
    before = texts(outputs[2])
    sets = {}
    for k, t in before.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        size = min(5, len(words))
        sets[k] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    roots = groups(before, lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * max(len(sets[a] | sets[b]), 1))
    assert texts(outputs[3]) == {k: t for k, t in before.items() if roots[k] == k}


def test_benchmark_stage(spark, outputs):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = defaultdict(set)
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        own = words(r.text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows[size].add(tuple(own[i : i + size]))

    def clear(text):
        own = words(text)
        return not any(tuple(own[i : i + size]) in held for size, held in windows.items() for i in range(len(own) - size + 1))

    before = texts(outputs[3])
    expected = {k: t for k, t in before.items() if clear(t)}
    assert texts(outputs[4]) == expected and len(expected) < len(before)


def test_encoding_stage(outputs):
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before = texts(outputs[4])
    assert {r.doc_id for r in outputs[5]} == before.keys()
    for r in outputs[5]:
        ids = own.encode(before[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_odd_documents_in_every_stage(spark):
    """Nulls, empty and long texts, repeated rows, further columns and an empty table."""
    rows = [(1, None, None, None, None), (None, "no id " * 5, "en", "s", 30), (2, "", "en", "s", 0), (3, "long word " * 150_000, "en", "s", 1_500_000), (4, "a b", "en", None, 3), (4, "a b", "en", None, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        if name != "keep_quality":  # learns from the labelled documents
            found = stage(spark, odd, FOLDER)
            kept = [r.doc_id for r in found.collect()]
            assert {1, 2, 3, 4, None} >= set(kept) >= {1, 2, 3}, name
        assert stage(spark, odd.limit(0), FOLDER).count() == 0, name
