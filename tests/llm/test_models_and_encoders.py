"""Formatting, tokenizers, classifiers and the pivot index, with odd rows."""

import json
import os
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwise.llm import arrow, chat_format, language_id, piece_ids, pivots, quality, recompression, token_counts
from cartwise.llm.components import components

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "the", "1", "23", "!", "é", "日本", " ", "😀", "<|endoftext|>", "\x00", "́", "▁", "<s>", "ation"]


def odd_texts(count):
    draw = random.Random(3)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(count)]


# --- Chat formatting -----------------------------------------------------------------------------


def spoken(df):
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text, r.formatted) for r in chat_format.read_back(df).collect()}


def test_layouts_by_fingerprint(spark):
    records = [
        (1, {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": {"text": 1}}),
        (2, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}),
        (3, {"instruction": "do", "input": "it", "output": "done"}),
        (4, {"instruction": "do", "output": "done", "score": 0.5}),
        (5, {"prompt": "p", "completion": "c"}),
        (6, {"prompt": {"messages": [{"role": "user", "content": "<|end|>\n"}]}}),
        (7, {"messages": []}),
        (8, {"unknown": 1}),
        (9, {"question": "q", "answer": None}),
    ]
    rows = spark.createDataFrame([(k, json.dumps(r)) for k, r in records] + [(10, "no json")], "id long, body string")
    found = spoken(chat_format.format_chats(rows, "id", json="body"))
    expected = {
        1: [("user", "q"), ("assistant", "a")],
        2: [("user", "q"), ("assistant", "a")],
        3: [("user", "do\n\nit"), ("assistant", "done")],
        4: [("user", "do"), ("assistant", "done")],
        5: [("user", "p"), ("assistant", "c")],
        6: [("user", "<|end|>\n")],
        7: [],
        8: [],
        9: [("user", "q"), ("assistant", "")],
        10: [],
    }
    assert {k: v[0] for k, v in found.items()} == expected
    assert found[3][1] == "done" and found[7][2] == ""
    layouts = {r.conv_id: r.layout for r in chat_format.canonical_turns(rows, "id", json="body").collect()}
    assert layouts[6] == "nested_messages" and layouts[7] == "messages" and layouts[8] is layouts[10] is None


def test_turn_rows_round_trip(spark):
    draw = random.Random(1)
    pieces = [*chat_format.TEMPLATE.control(), "\\", "<", "[", "|end|>", "\n", "text", "😀", "\\<"]
    rows = []
    for k in range(40):
        for turn in range(draw.randint(1, 5)):
            rows.append((k, turn, draw.choice(["user", "assistant", "tool<|body|>"]), "".join(draw.choice(pieces) for _ in range(draw.randint(0, 9))), "clash"))
    schema = "conv_id long, turn long, role string, text string, formatted string"
    table = spark.createDataFrame(rows, schema).repartition(4)
    found = spoken(chat_format.format_chats(table, "conv_id"))
    for k in range(40):
        own = [r for r in rows if r[0] == k]
        assert found[k][0] == [(r[2], r[3]) for r in own]
        assert found[k][1] == "".join(r[3] for r in own if r[2] == "assistant")
        for s in chat_format.TEMPLATE.reserved:
            assert s not in found[k][2]


def test_odd_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame([(1, 1, None, None), (1, None, "user", "first"), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 0, "user", "a"), (None, 0, "user", "b")], schema)
    rows = chat_format.read_back(chat_format.format_chats(table, "conv_id")).collect()
    assert len(rows) == 4
    turns = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in rows}
    assert turns[1] == [("user", "first"), ("", "")] and turns[2] == [("user", "x")] * 2
    assert chat_format.format_chats(table.limit(0), "conv_id").count() == 0


# --- Tokenizers ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(odd_texts(3000))] + [(None, None, "clash", 1), (0, None, "clash", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(4)


def test_token_counts(odd):
    own = Tokenizer.from_file(BYTES)
    for r in token_counts.count_tokens(odd.withColumn("copy", F.col("text")), BYTES).collect():
        text = r["copy"] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(own.encode(text, add_special_tokens=False).ids))
    assert token_counts.count_tokens(odd.limit(0), BYTES).count() == 0


def test_chunks_inside_words(monkeypatch):
    own, classes = Tokenizer.from_file(BYTES), token_counts.character_classes(BYTES)
    draw = random.Random(4)
    texts = ["".join(draw.choice("abcdethein") for _ in range(draw.randint(1, 400))) for _ in range(80)]
    texts += [" " * 700, "a" * 900, "=" * 600, "word " * 300]
    expected = [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]
    for chunk in (3, 16, 512):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        assert token_counts.count_batch(texts, BYTES, classes).tolist() == expected


def test_pieces(odd):
    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = piece_ids.word_counts(odd)
    table = piece_ids.segment_table(counts, PIECES, rows=2000)
    assert 0 < table.count() <= 2000
    for r in piece_ids.encode(odd.withColumn("copy", F.col("text")), table, PIECES).select("copy", "n_tokens", "ids", "decoded").collect():
        ids = own.encode(r[0] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == own.decode(ids)
    nothing = odd.limit(0)
    assert piece_ids.encode(nothing, piece_ids.segment_table(piece_ids.word_counts(nothing), PIECES), PIECES).count() == 0


def test_pieces_of_long_texts(monkeypatch):
    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    monkeypatch.setattr(piece_ids, "PIECE_CHARS", 5)
    encoder = piece_ids.Encoder(PIECES, {})
    for text in odd_texts(3000):
        ids, decoded = encoder.both(text)
        expected = own.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == expected and decoded == own.decode(expected)


# --- Classifiers ---------------------------------------------------------------------------------


def test_quality(spark):
    draw = random.Random(2)
    good, bad = ["the", "house", "of", "words", "stands"], ["BUY", "!!!", "now$$", "%%%"]
    rows = [(i, " ".join(draw.choice(good if i % 3 else bad) for _ in range(20)), int(i % 3 > 0)) for i in range(300)]
    documents = spark.createDataFrame([(i, t, 0.5, "x") for i, t, _ in rows] + [(900, None, 0.5, "x"), (901, "", 0.5, "x")], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 200] + [(None, 1), (3, None)], "doc_id long, quality int")
    scored = {r.doc_id: r for r in quality.score(documents, quality.train(documents, labels)).collect()}
    assert all((scored[i].score >= 0.3) == bool(y) for i, _, y in rows if i >= 200)
    assert scored[900].score == scored[901].score and scored[0].label == "x"
    again = {r.doc_id: r.score for r in quality.score(documents, quality.train(documents.repartition(7), labels.repartition(3))).collect()}
    assert all(again[k] == r.score for k, r in scored.items())
    untrained = quality.train(documents, labels.limit(0))
    assert quality.score(documents, untrained).filter("score = 0.5").count() == 302
    assert quality.score(documents.limit(0), untrained).count() == 0


def test_quality_is_learned_in_a_task(spark, monkeypatch):
    """The driver gathers the model, not the examples it is learned from."""
    monkeypatch.setattr(quality, "fit", lambda examples, settings: quality.Model(np.full(quality.BUCKETS, len(examples), dtype=np.float32), float(os.getpid())))
    documents = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    model = quality.train(documents, labels)
    assert model.bias != os.getpid() and model.weights.tolist() == [20] * quality.BUCKETS


def test_languages(spark):
    en, fr = "the house of the man and that was in with ", "le chat est dans la maison avec une pour qui "
    rows = [(i, en * 3, "en") for i in range(20)] + [(i, fr * 3, "fr") for i in range(20, 40)] + [(50, "x", None), (51, None, "en")]
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language_id.learn(language_id.count_grams(texts).persist())
    asked = [(1, "That Man WAS in the house", 1.0), (2, "une maison avec le chat", 1.0), (3, None, 1.0), (4, "12 34 !!", 1.0), (5, "", 1.0), (6, "a", 1.0)]
    asked = spark.createDataFrame(asked, "doc_id long, text string, score double")
    found = {r.doc_id: r for r in language_id.predict(asked, filters).collect()}
    assert [found[i].lang_pred for i in range(1, 6)] == ["en", "fr", "und", "und", "und"] and found[6].lang_pred in ("en", "fr")
    assert found[3].score == 0 and found[1].score > 0.5
    none = language_id.learn(language_id.count_grams(texts.limit(0)))
    assert {r.lang_pred for r in language_id.predict(asked, none).collect()} == {"und"}
    assert language_id.predict(asked.limit(0), filters).count() == 0


def test_many_languages():
    names, draw = [f"l{i:03}" for i in range(130)], np.random.default_rng(1)
    grams = [draw.integers(0, 1 << 32, 200) for _ in names]
    filters = language_id.build(names, np.concatenate(grams), np.repeat(np.arange(130), 200))
    assert filters.slots.shape[0] == 3
    for i in (0, 63, 129):
        masks = filters.masks(grams[i].astype(np.uint32), 2)
        assert (masks[i // 63] >> np.uint64(i % 63) & np.uint64(1)).all()


# --- Vectors and components ----------------------------------------------------------------------


def test_components(spark):
    draw = random.Random(6)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(100)]
    root = {n: n for pair in links for n in pair}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    expected = {n: find(n) for n in root if find(n) != n}
    table = spark.createDataFrame([*links, (5, 5), (None, 3)], "a long, b long").repartition(6)
    assert {r.node: r.component for r in components(table).collect()} == expected
    assert components(table.limit(0)).count() == 0


def test_near_vectors_against_all_pairs(spark):
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(30, 32))
    vectors = [list(map(float, v)) for c in centres for v in c + 0.06 * draw.normal(size=(30, 32))]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[1]], None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [1.0, None], [1.0, 2.0], [2.0, 4.0]]
    labels = [int(i % 3) for i in range(len(vectors))]
    labels[5] = None
    rows = [(i, v, y, 7, "x") for i, (v, y) in enumerate(zip(vectors, labels))]
    table = spark.createDataFrame(rows + [(None, vectors[0], 0, 7, "x")], "vec_id long, embedding array<double>, label int, links int, id string").repartition(5)
    good = [i for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v) and labels[i] is not None]
    unit = {i: np.array(vectors[i]) / np.linalg.norm(vectors[i]) for i in good}
    linked = {i: {j for j in good if i != j and labels[i] == labels[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98} for i in good}
    settings = pivots.Settings(pivots=48, block=20)
    rows = pivots.near_duplicates(table, "vec_id", "embedding", "label", 0.98, settings).collect()
    found = {r.vec_id: r for r in rows if r.vec_id is not None}
    assert len(rows) == len(vectors) + 1
    for i in set(range(len(vectors))) - set(good):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    total = sum(map(len, linked.values()))
    assert total > 300 and all(found[i].n_links <= len(linked[i]) for i in good)
    assert sum(found[i].n_links for i in good) >= 0.9 * total
    assert all(found[i].kept == (found[i].component_id == i) for i in found)
    assert pivots.near_duplicates(table.limit(0), "vec_id", "embedding", "label").count() == 0


def test_columns_with_dots_pass_through(spark):
    rows = spark.createDataFrame([(1, "one two three", 5), (2, None, 6)], "doc_id long, text string, `a.b` int")
    model = quality.Model(np.zeros(1 << quality.BITS, dtype=np.float32), 0.0)
    table = piece_ids.segment_table(piece_ids.word_counts(rows), PIECES)
    found = [
        piece_ids.encode(rows, table, PIECES),
        token_counts.count_tokens(rows, BYTES),
        language_id.predict(rows, language_id.learn(language_id.count_grams(rows.select("text", F.lit("en").alias("lang"))))),
        recompression.remove_repeats(rows),
        quality.score(rows, model),
    ]
    for df in found:
        assert {r.doc_id: r["a.b"] for r in df.collect()} == {1: 5, 2: 6}


def test_batches_for_python_are_bounded_by_their_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    rows = arrow.bounded(spark).range(0, 6000, 1, 1)
    wide = rows.selectExpr("repeat('x', 4000) AS text").mapInArrow(sizes, "n long")
    assert max(r.n for r in wide.collect()) < 2 * arrow.BATCH_BYTES / 4000
    assert [r.n for r in rows.mapInArrow(sizes, "n long").collect()] == [6000]
