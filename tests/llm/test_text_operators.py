"""Operators on texts against brute force, with nulls, repeats, ties, clashing columns and empty tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import decontaminate, fuzzy_lines, linking, ngram_join, recompression
from cartwise.session import materialise

random.seed(5)
SCHEMA = "doc_id long, text string, k string, t int, n int, node string, key string, kept string, n_words long, lines int"
EXTRA = ("x",) + (1, 2) + ("n", "k", "own", -1, -2)


def words(count, vocabulary):
    return [random.choice(vocabulary) for _ in range(count)]


WIDE = [f"w{i}" for i in range(3000)]
BASE = words(120, WIDE)
PASSAGE = words(40, WIDE)


def corpus():
    near = BASE[:50] + ["other"] + BASE[51:]
    texts = [
        (10, " ".join(BASE)),
        (11, " ".join(near)),
        (12, "  ".join(BASE).upper()),
        (13, " ".join(words(60, WIDE) + PASSAGE + words(60, WIDE))),
        (14, " ".join(words(10, WIDE) + PASSAGE + words(90, WIDE))),
        (15, " ".join(PASSAGE[5:38])),
        (16, "a b"),
        (17, "a  b"),
        (18, "spam " * 70),
        (19, ""),
        (20, None),
        (21, " \t\n "),
        (22, " ".join(words(300, ["aa", "bb"]))),
        (23, " ".join(words(300, ["aa", "bb"]))),
        (24, "é" * 40 + " ü"),
    ]
    texts += [(30 + i, " ".join(BASE[: 60 + i] + words(3, WIDE) + BASE[63 + i :])) for i in range(8)]
    return texts


TEXTS = corpus()


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(k, t, *EXTRA) for k, t in TEXTS]
    rows += [rows[0], (None, " ".join(BASE), *EXTRA), (None, None, *EXTRA)]  # a repeated row, rows without an id
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(documents):
    return documents.limit(0)


def groups(nodes, linked):
    """Smallest reachable node of each."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_similar_documents(documents, nothing):
    lower = {k: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for k, t in TEXTS}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set() for k, w in lower.items()}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)

    expected = groups(sets, linked)
    assert len(set(expected.values())) < len(expected) - 5
    found = ngram_join.similar_documents(documents).collect()
    assert len(found) == documents.count()
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), expected[r.doc_id])
        else:
            assert r.component_id is None
    assert ngram_join.similar_documents(nothing).count() == 0


def test_a_copy_without_id_in_first_place(spark):
    near = " ".join(BASE[:50] + ["other"] + BASE[51:])
    rows = [(None, " ".join(BASE)), (8, " ".join(BASE)), (3, near)]
    for some in (rows, rows[::-1]):
        documents = spark.createDataFrame(some, "doc_id long, text string").coalesce(1)
        assert {r.doc_id: r.component_id for r in ngram_join.similar_documents(documents).collect()} == {None: None, 8: 3, 3: 3}


def brute_repeats(texts):
    """doc -> (number of words, removed, rest), documents in order."""
    seen, out = set(), {}
    for key, text in texts:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(own) - 19):
            window = tuple(own[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        out[key] = len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)
    return out


def test_repeats_of_words(spark, nothing):
    rows = [(k, t, *EXTRA) for k, t in TEXTS]
    found = recompression.remove_repeats(spark.createDataFrame([*rows, rows[0]], SCHEMA).repartition(4)).collect()
    expected = brute_repeats(TEXTS)
    assert len(found) == len(rows) + 1 and found[0].k == "x"
    assert all((r.n_words, r.n_removed, r.kept) == expected[r.doc_id] for r in found)
    assert expected[10][1] == 0 and expected[11][1] > 50 and expected[18][1] == 69
    assert recompression.remove_repeats(nothing).count() == 0


def test_a_row_without_id_comes_first(documents):
    found = {(r.doc_id, r.n_removed) for r in recompression.remove_repeats(documents).collect() if r.doc_id in (None, 10) and r.n_words}
    assert found == {(None, 0), (10, 120)}


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 7, 40])
def test_repeats_in_few_words(spark, vocabulary):
    letters = [f"v{i}" for i in range(vocabulary)]
    seed = words(60, letters)
    texts = []
    for i in range(40):
        low = random.randrange(40)
        texts.append((i, " ".join(words(random.randrange(30), letters) + seed[low : low + random.randrange(60)] + words(random.randrange(30), letters))))
    documents = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    expected = brute_repeats(texts)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in recompression.remove_repeats(documents).collect()} == expected


@pytest.mark.parametrize("seldom", [0, 3, 1000])
def test_repeats_under_seldom_and_frequent_phrases(spark, monkeypatch, seldom):
    monkeypatch.setattr(recompression, "SELDOM", seldom)
    passage, texts = words(60, WIDE), []
    for i in range(30):
        low = random.randrange(30)
        shared = passage[low : low + 30] if i % 2 else passage[:25] + [f"n{i}"] + passage[26:]
        texts.append((i // 2 if i < 6 else i, " ".join(words(random.randrange(9), WIDE) + shared + words(random.randrange(9), WIDE) + shared[: i % 4 * 7])))
    texts += [(None, texts[7][1]), (50, " ".join(passage)), (51, " ".join(passage + ["end"] + passage))]
    documents = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    # Rows that share an id are in the order of a hash of the text.
    ordered = [(r.doc_id, r.text) for r in documents.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()]
    seen, expected = set(), {}
    for key, text in ordered:
        own, gone = text.split(), set()
        for i in range(len(own) - 19):
            window = tuple(own[i : i + 20])
            gone |= set(range(i, i + 20)) if window in seen else set()
            seen.add(window)
        expected[key, text] = len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)
    found = recompression.remove_repeats(documents.withColumn("whole", F.col("text"))).collect()
    assert len(found) == len(texts) and {(r.doc_id, r.whole): (r.n_words, r.n_removed, r.kept) for r in found} == expected


def test_windows_under_a_seldom_phrase_travel_together(spark, monkeypatch):
    rows = {}

    def counted(frame, name):
        out = materialise(frame, name)
        rows[name] = out
        return out

    monkeypatch.setattr(recompression, "materialise", counted)
    base = words(2000, WIDE)
    texts = [(i, " ".join(words(5, WIDE) + base[: 400 * i])) for i in range(1, 6)]
    recompression.marks(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), "doc_id", "text")
    windows = rows["windows"].select(F.count("*"), F.sum(F.size("v")), F.sum(F.size("w"))).first()
    assert windows[1] > 5000 and windows[2] == 0
    assert windows[0] < windows[1] / 2


def test_contamination(spark, documents, nothing):
    long_item, short_item = " ".join(PASSAGE[3:33]).title(), "A, b!"
    benchmark = spark.createDataFrame(
        [(1, long_item, "x"), (1, long_item, "y"), (2, short_item, "x"), (3, "spam", "x"), (4, "", "x"), (5, None, "x"), (None, "é" * 40, "x"), (7, "w1 unseen w2", "x")],
        "item_id long, text string, item string",
    )
    found = {(r.doc_id, r.n_words): r for r in decontaminate.contamination(documents, benchmark).collect()}
    by_id = {k: r for (k, _), r in found.items()}
    assert by_id[13].n_hit == by_id[14].n_hit == 30 and by_id[13]["items"] == ["1"]
    assert by_id[15].n_hit == 28 and by_id[18].n_hit == 70 and by_id[18]["items"] == ["3"]
    assert by_id[16].n_hit == by_id[17].n_hit == 2 and by_id[16]["items"] == ["2"]
    assert by_id[24].n_hit == 1 and by_id[24]["items"] == ["null"]
    assert not any(by_id[k].contaminated for k in (10, 11, 19, 20, 21, 22, 30)) and by_id[20].n_words == 0
    assert decontaminate.contamination(documents, benchmark).count() == documents.count()
    assert decontaminate.contamination(nothing, benchmark).count() == 0
    assert not decontaminate.contamination(documents, benchmark.limit(0)).filter("contaminated OR n_hit > 0").count()


def test_lines(spark, nothing):
    long_line = " ".join(words(30, WIDE))
    near = long_line[:-1] + "#"
    far = " ".join(words(30, WIDE))
    texts = [
        (2, f"{long_line}\nshort\n{far}"),
        (3, f"short\n  {long_line.upper()}  \n{near}\n\nshort"),
        (4, near),
        (4, near),
        (5, None),
        (6, ""),
        (7, "\n\n"),
        (1, far + " and quite a few other words that were not here before, so that it is another line by now" * 3),
    ]
    documents = spark.createDataFrame([(k, t, *EXTRA) for k, t in texts], SCHEMA).repartition(3)
    found = defaultdict(list)
    for r in fuzzy_lines.dedup_lines(documents).collect():
        found[r.doc_id].append((r.text, r.lines, r.lines_removed))
    assert found[2] == [(texts[0][1], 3, 0)]
    assert found[3] == [("", 5, 4)]
    assert found[4] == [("", 1, 1)] * 2
    assert found[5] == [(None, 0, 0)] and found[6] == [("", 1, 0)] and found[7] == [("\n\n", 3, 0)]
    assert found[1][0][2] == 0
    assert fuzzy_lines.dedup_lines(nothing).count() == 0


def test_repeated_short_lines(spark):
    texts = [(1, "All rights reserved.\nab\n\n \t\né"), (2, "  ALL RIGHTS RESERVED. \nAB\n\n \t\nac"), (3, "é\nab\r\n\r\n\r\nac\nac"), (4, "seven c\neight ch\nseven d")]
    documents = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.text, r.lines_removed) for r in fuzzy_lines.dedup_lines(documents, settings=fuzzy_lines.CORPUS).collect()}
    assert found == {1: (texts[0][1], 0), 2: ("\n \t\nac", 2), 3: ("ab\r\n\r\n\r", 3), 4: (texts[3][1], 0)}


def test_lines_with_one_changed_letter(spark):
    lines = ["the quick brown fox jumps over the lazy dog of my old aunt", "съешь же ещё этих мягких французских булок да выпей чаю"]
    rows = [(2 * i, x) for i, x in enumerate(lines)] + [(2 * i + 1, x[:30] + "#" + x[31:]) for i, x in enumerate(lines)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.lines_removed for r in fuzzy_lines.dedup_lines(documents, settings=fuzzy_lines.CORPUS).collect()}
    assert found == {0: 0, 1: 1, 2: 0, 3: 1}


def shingles(line):
    return {line[i : i + 5] for i in range(max(len(line) - 4, 1))}


def all_pairs_removed(texts):
    """Places (key, at) to remove, by comparing all lines of ``texts`` (key to text)."""
    places = [(k, i, x.strip(" ").lower()) for k, t in sorted(texts.items()) for i, x in enumerate(t.split("\n"))]
    places = [p for p in places if p[2].strip()]
    lines = sorted({p[2] for p in places})
    sets = [shingles(x) for x in lines]
    at, linked = defaultdict(list), defaultdict(set)
    for i, own in enumerate(sets):
        common = Counter(j for s in own for j in at[s])
        for j, c in common.items():
            if c >= 0.75 * (len(own) + len(sets[j]) - c):
                linked[i].add(j)
                linked[j].add(i)
        for s in own:
            at[s].append(i)
    root, seen = {}, set()
    for i in range(len(lines)):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in seen:
                seen.add(j)
                root[lines[j]] = i
                todo += linked[j]
    first, gone = set(), set()
    for k, i, x in places:
        if root[x] in first:
            gone.add((k, i))
        first.add(root[x])
    return gone


def test_corpus_lines_against_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {(r.k, r["at"]) for r in fuzzy_lines.removed(documents).collect()}
    expected = all_pairs_removed(texts)
    # A lost link can also make another line the first of what is left.
    assert len(expected) > 200 and len(found & expected) >= 0.98 * len(expected) and len(found - expected) <= 0.01 * len(expected)


def test_keys_of_many_lines(spark, monkeypatch):
    """A band with more lines than a task compares, and groups of more lines than a block holds."""
    monkeypatch.setattr(fuzzy_lines, "MANY", 40)
    monkeypatch.setattr(linking, "BLOCK_NODES", 16)
    own = words(25, WIDE)
    family = [" ".join([*own[:i], f"new{i}", *own[i + 1 :]]) for i in range(25)] + [" ".join([*own, f"tail{i}"]) for i in range(150)]
    rest = [" ".join(words(12, WIDE)) for _ in range(40)]
    texts = dict(enumerate(family + rest))
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {(r.k, r["at"]) for r in fuzzy_lines.removed(documents).collect()} == all_pairs_removed(texts)


def test_groups_of_close_sketches(monkeypatch):
    """Keys of any size in one batch, against all pairs; those with more than MANY lines are dealt, not compared by one task."""
    monkeypatch.setattr(fuzzy_lines, "MANY", 150)
    rng = np.random.default_rng(3)
    least, own, expected = fuzzy_lines._least_agreeing(fuzzy_lines.CORPUS), [], set()
    for key, size in enumerate([1, 2, 5, 40, 64, 65, 100, 150, 151, 400]):
        base = rng.integers(0, 1 << 62, (2, 1 + size // 10), dtype=np.int64)
        nodes = np.sort(rng.choice(10_000, size, replace=False)) + 10_000 * key
        sketches = base[:, rng.integers(0, base.shape[1], size)]
        for _ in range(3):
            sketches = sketches ^ (rng.integers(0, 16, (2, size)) << 4 * rng.integers(0, 15, (2, size)))
        own.append(np.stack([np.full(size, key), nodes, *sketches]))
        s, t = sketches.view(np.uint64)
        alike = fuzzy_lines.agreeing(s[:, None], t[:, None], s, t) >= least
        assert alike[0, -1] == (sum((int(a) ^ int(b)) >> 4 * i & 15 == 0 for a, b in ((s[0], s[-1]), (t[0], t[-1])) for i in range(16)) >= least)
        pairs = [(int(nodes[i]), int(nodes[j])) for i, j in zip(*np.nonzero(alike)) if i < j]
        if size <= 150:
            expected |= {(root, k) for k, root in reached([int(x) for x in nodes], pairs).items() if any(k in p for p in pairs)}
    rows = np.concatenate(own, axis=1)
    rows = np.concatenate([rows, rows[:, ::3]], axis=1)
    rows = rows[:, np.argsort(rows[0], kind="stable")]  # nodes in any order, some twice
    found = [r for batch in fuzzy_lines._grouped(rows, least) for r in batch.to_pylist()]
    assert {(r["group"], r["node"]) for r in found if r["key"] is None} == expected
    assert sorted(r["node"] for r in found if r["key"] is not None) == sorted(np.concatenate([own[8][1], own[9][1]]).tolist())


def test_texts_are_cut_into_lines_once(spark):
    """Not again for each of their lines."""
    texts = [(1, "\n".join(f"line {i} of {i * i}" for i in range(50))), (2, "a\nline 7 of 49\n\nb"), (3, None), (4, "")]
    left = fuzzy_lines.dedup_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    assert left._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    found = {r.doc_id: (r.text, r.lines, r.lines_removed) for r in left.collect()}
    assert found[2] == ("a\n\nb", 4, 1) and found[3] == (None, 0, 0) and found[4] == ("", 1, 0) and found[1][1] == 50


def reached(nodes, pairs):
    linked = {frozenset(p) for p in pairs}
    return groups(nodes, lambda a, b: frozenset((a, b)) in linked)


@pytest.mark.parametrize("block, weight", [(500, 10_000), (7, 10_000), (500, 60), (1, 1)])
def test_blocks_find_every_component(spark, block, weight):
    """Sets that are just too far apart, chains, and a centre with many, against all pairs of each group."""
    rng = random.Random(block)
    base = list(range(20))
    sets = [base] + [base[:i] + [100 + i] + base[i + 1 :] for i in range(20)] + [base[:k] + rng.sample(range(1000, 2000), 20 - k) for k in range(8, 20) for _ in range(3)]
    sets += [rng.sample(range(30), 18) for _ in range(40)]
    members = [(g, n) for g in (-5, 3, 9) for n in range(len(sets)) if (n * 7 + g) % (2 if g == 3 else 3)]
    members += [(100 + g, n) for g in range(200) for n in rng.sample(range(len(sets)), rng.choice([1, 2, 3, 20]))]  # small groups, side by side
    rows = spark.createDataFrame(members, "group long, node long")
    items = spark.createDataFrame([(n, len(x), sorted(x)) for n, x in enumerate(sets)], "node long, weight long, own array<long>")

    def similar(own, side, block):
        columns, sizes = np.concatenate([x.flatten().to_numpy() for x in own]), np.concatenate([x.value_lengths().to_numpy() for x in own])
        return linking.similar_sets(columns, sizes, side, block, 75)

    found = linking.block_links(materialise(rows, "rows"), materialise(items, "items"), similar, block, weight).collect()
    held = defaultdict(set)
    for g, n in members:
        held[g].add(n)
    pairs = {(a, b) for own in held.values() for a in own for b in own if a < b and len({*sets[a]} & {*sets[b]}) >= 0.75 * len({*sets[a]} | {*sets[b]})}
    assert len(pairs) > 50 and reached(range(len(sets)), [(r.a, r.b) for r in found]) == reached(range(len(sets)), pairs)


def test_overlaps_over_runs_of_columns(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(-(1 << 62), 1 << 62, 300) // (1 << 53)) for _ in range(30)] + [np.zeros(0, dtype=np.int64)]
    for columns in (64, 1 << 13):
        monkeypatch.setattr(linking, "COLUMNS", columns)
        for side in (np.zeros(31, dtype=int), np.arange(31) % 2):
            for x, other, common in linking.overlaps(np.concatenate(sets), np.array([len(s) for s in sets]), side):
                assert common.tolist() == [len(np.intersect1d(sets[x], sets[y])) for y in other]


def test_near_lines_against_all_pairs(spark):
    lines = []
    for _ in range(60):
        own = words(25, WIDE)
        for _ in range(random.choice([1, 1, 2, 5])):
            for _ in range(random.choice([0, 1, 1, 2, 4])):
                own[random.randrange(25)] = random.choice(WIDE)
            lines.append(" ".join(own))
    documents = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    sets = [shingles(x) for x in lines]
    expected = groups(range(len(lines)), lambda a, b: len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b]))
    removed = {r.doc_id for r in fuzzy_lines.dedup_lines(documents).filter("lines_removed > 0").collect()}
    expected_removed = {k for k, root in expected.items() if k != root}
    assert removed <= expected_removed and len(removed) >= 0.95 * len(expected_removed)


def test_very_long_texts(spark):
    own = words(250_000, WIDE)  # more than a slab
    copy = own[100_000:100_500]
    documents = spark.createDataFrame([(1, " ".join(own)), (2, " ".join(copy)), (3, " ".join(own))], "doc_id long, text string")
    found = {r.doc_id: r for r in recompression.remove_repeats(documents).select("doc_id", "n_words", "n_removed").collect()}
    assert (found[1].n_words, found[1].n_removed) == (250_000, 0)
    assert found[2].n_removed == 500 and found[3].n_removed == 250_000
    joined = {r.doc_id: r.component_id for r in ngram_join.similar_documents(documents).collect()}
    assert joined == {1: 1, 2: 2, 3: 1}
    assert documents.select(F.max(F.length("text"))).first()[0] > 1 << 20


def test_a_word_longer_than_a_slab(spark):
    passage, other = words(30, WIDE), words(40, WIDE)
    long_word = "".join(random.choices("abcé", k=3 << 20))
    texts = [
        (1, " ".join([*passage, long_word, *other, *passage, "end"])),
        (2, " ".join([*other[:25], long_word, *passage[:19]])),
        (3, " ".join([*words(18, WIDE), long_word])),
        (4, " ".join(["new", *passage, long_word, *other, *passage, "end"])),
        (5, long_word),
    ]
    documents = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in recompression.remove_repeats(documents).collect()}
    assert found == brute_repeats(texts)
    assert found[1][1] == 30 and found[2][1] == 25 and found[3][0] == 19 and found[4][1] == 102
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for k, w in ((k, t.split()) for k, t in texts)}
    joined = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(documents).collect()}
    assert joined == {k: (len(own), 1 if k == 4 else k) for k, own in sets.items()}
