"""What a Python worker holds for a batch is bounded by pieces of it, not by the batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cartwise.llm import linking, quality, slabs, word_runs

WORDS = ["".join(map(chr, codes)) for codes in np.random.default_rng(1).integers(97, 123, (2000, 5))]


@pytest.fixture(scope="module")
def texts() -> list[str]:
    random = np.random.default_rng(2)
    return [" ".join(random.choice(WORDS, 300)) for _ in range(2200)]


def peak_mb(work) -> float:
    slabs._TABLES.clear()
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_word_hashes_of_many_short_texts(texts):
    own = [x.encode() for x in texts]
    assert peak_mb(lambda: [None for _ in word_runs.word_arrays(own, lower=True)]) < 25


def test_packing_does_not_change_hashes(texts, monkeypatch):
    own = [x.encode() for x in [*texts[:50], "", "é 日本", " ".join(texts[:40])]]
    small = list(word_runs.word_arrays(own, lower=True))
    for together in (1, 1000, 1 << 20):
        monkeypatch.setattr(word_runs, "TOGETHER", together)
        other = list(word_runs.word_arrays(own, lower=True))
        assert [n for n, _ in other] == [n for n, _ in small] == list(range(len(own)))
        assert all((a == b).all() for (_, a), (_, b) in zip(small, other))


def test_feature_counts_of_a_batch(texts):
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(texts)), pa.array(texts)], ["label", "text"])
    assert peak_mb(lambda: [None for _ in quality._counted(iter([batch]))]) < 60


def test_feature_counts_do_not_depend_on_parts(texts, monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 1, 0]), pa.array([texts[0], None, "", texts[1]])], ["label", "text"])
    whole = [row for part in quality._counted(iter([batch])) for row in part.to_pylist()]
    monkeypatch.setattr(quality, "COUNTED_BYTES", 1)
    parts = list(quality._counted(iter([batch])))
    assert len(parts) == 4 and [row for part in parts for row in part.to_pylist()] == whole


def test_small_blocks_of_text_come_in_bounded_runs():
    lines = ["x" * 100] * 12_000
    group = np.repeat(np.arange(6000), 2)
    zero = np.zeros(12_000, dtype=np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(group), pa.array(zero), pa.array(zero), pa.array(lines)], ["group", "i", "j", "own"])
    sizes, seen = [], 0
    for rows, block in linking._blocks(iter([batch]), ["group", "i", "j"]):
        sizes.append(sum(len(x) for part in rows for x in part.column("own").to_pylist()))
        seen += len(block)
    assert seen == 12_000 and max(sizes) < 300_000
