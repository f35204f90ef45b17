from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from shelfledger.llm import ngram_join as join
from shelfledger.llm.common import Stage, table
from shelfledger.llm.graph import components
from shelfledger.llm.shingles import mixed, shingle_sets, word_hashes


def plain_set(text, size):
    lowered = (text or "").translate({n: n + 32 for n in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    whole = {tuple(words)} if words else set()
    return {tuple(words[n : n + size]) for n in range(len(words) - size + 1)} if len(words) >= size else whole


def plain_classes(rows, size, numerator, denominator):
    """All pairs, and repeated passes that hand down the smallest id."""
    sets = [plain_set(text, size) for _, text in rows]
    ids = [doc_id for doc_id, _ in rows]
    links = []
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * denominator >= numerator * max(len(sets[a]), len(sets[b])):
            if denominator * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b]):
                links.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(ids[a], ids[b])
            changed |= ids[a] != least or ids[b] != least
            ids[a] = ids[b] = least
    return sorted((doc_id, len(s), least) for (doc_id, _), s, least in zip(rows, sets, ids, strict=True))


def joined(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in join.ngram_join(df, **options).collect())


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


def corpus(seed):
    """Short and long texts, groups of near copies of all distances, a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{n}é" for n in range(400)]
    passage = rng.choices(vocabulary, k=25)
    texts = []
    for length in [*range(0, 30), 40, 60, 80, 120, 200]:
        base = rng.choices(vocabulary, k=length)
        texts.append(base)
        texts += [edited(rng, base, n % 4, vocabulary) for n in range(4) if base]
    hub = rng.choices(vocabulary, k=90)
    texts += [edited(rng, hub, rng.randrange(4), vocabulary) for _ in range(60)]
    texts += [rng.choices(vocabulary, k=30) + passage for _ in range(40)]
    texts += [hub[n : n + 80] for n in range(0, 10, 2)]
    rng.shuffle(texts)
    return [(n * 3, " ".join(words)) for n, words in enumerate(texts)]


@given(st.lists(st.text(alphabet="aB é\t\x0b\x1f\x85 ", max_size=12), max_size=6), st.integers(1, 4))
def test_shingles_equal_plain_ones(texts, size):
    sets = list(shingle_sets(pa.array(texts, pa.string()), size))
    assert [len(s) for s in sets] == [len(plain_set(text, size)) for text in texts]
    for (a, x), (b, y) in combinations(zip(texts, sets, strict=True), 2):
        assert len(np.intersect1d(x, y)) == len(plain_set(a, size) & plain_set(b, size))


@given(st.sets(st.integers(0, 300)), st.sets(st.integers(0, 300)), st.integers(1, 100))
def test_sketches_never_lose_a_pair(a, b, numerator):
    sets = [np.sort(mixed(np.array(sorted(x), np.uint64))) for x in (a, b)]
    rows = [np.frombuffer(join.sketch(s), np.uint8)[None] for s in sets]
    threshold = join.Threshold(numerator, 100)
    if threshold.holds(len(a & b), len(a), len(b)):
        assert join.may_hold(threshold, *rows, len(a), len(b))[0]


def test_full_sketches_are_kept():
    full, other = np.full((1, 64), join.FULL, np.uint8), np.ones((1, 32), np.uint8)
    assert join.may_hold(join.Threshold(85, 100), full, other, 100_000, 32)[0]


def test_sliced_and_long_columns():
    texts = pa.array(["skip", None, "a b c d e " * 30_000, "a b c d e", "x" * 300_000])
    assert [len(s) for s in shingle_sets(texts.slice(1), 4)] == [0, 5, 2, 1]


@pytest.mark.parametrize(("size", "numerator", "denominator"), [(4, 85, 100), (5, 80, 100), (2, 50, 100)])
def test_against_all_pairs(spark, size, numerator, denominator, monkeypatch):
    monkeypatch.setattr(join, "LONG_LIST", 4)
    monkeypatch.setattr(join, "LEADERS", 1)
    monkeypatch.setattr(join, "BLOCK_ROWS", 9)
    monkeypatch.setattr(join, "CARRIED_KEYS", 3)
    monkeypatch.setattr(join, "PAIRS_PER_TASK", 5)
    rows = corpus(size)
    options = {"size": size, "numerator": numerator, "denominator": denominator}
    assert joined(spark, rows, **options) == plain_classes(rows, **options)


def test_subsets_of_small_sets_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(join, "PAIR_COST", 1000.0)
    rows = corpus(9)
    assert join.boundary(join.Threshold(85, 100), 1.0) > 30
    assert joined(spark, rows, size=4, numerator=85) == plain_classes(rows, 4, 85, 100)


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    assert joined(spark, rows, size=4, numerator=85) == plain_classes(rows, 4, 85, 100)


def test_rows(spark):
    long = " ".join(f"w{n}" for n in range(60_000))
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "A B C D E F"), (None, "a b c d e f"), (5, None), (6, " \t "), (None, None)]
    rows += [(8, long), (9, f"{long} x"), (1, "a b"), (2, "a b")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, sig string")
    got = sorted((tuple(r) for r in join.ngram_join(df, size=4, numerator=85).collect()), key=str)
    expected = [(7, 3, 3), (7, 3, 3), (3, 3, 3), (None, 3, 3), (5, 0, 5), (6, 0, 6), (None, 0, None)]
    expected += [(8, 59_997, 8), (9, 59_998, 8), (1, 1, 1), (2, 1, 1)]
    assert got == sorted(expected, key=str)
    assert join.ngram_join(df.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(n, n + 1) for n in range(1000, 1100)] + [(None, 1)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), Stage(spark)).collect())
    least = {n: n for edge in edges if None not in edge and edge[0] != edge[1] for n in edge}
    for _ in range(200):
        for a, b in edges:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
    assert got == least


def test_words_built_against_polynomial_hashes_stay_apart(spark):
    """The Thue-Morse word of 1,024 letters and its complement have equal polynomials over 64 bits, whatever the base."""
    word = "".join("ab"[n.bit_count() % 2] for n in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    for length in (1024, 512, 64):
        assert joined(spark, [(1, word[:length]), (2, other[:length])]) == [(1, 1, 1), (2, 1, 2)]


@given(st.lists(st.text(alphabet="aAbé😀", min_size=1, max_size=90), min_size=1, max_size=8))
def test_equal_words_have_equal_hashes_wherever_they_stand(words):
    text = " ".join([*words, *reversed(words)])
    _, hashes = word_hashes(np.frombuffer(text.encode(), np.uint8))
    lowered = [w.translate({65: 97}) for w in [*words, *reversed(words)]]
    assert len(set(zip(lowered, hashes.tolist(), strict=True))) == len(set(lowered)) == len(set(hashes.tolist()))


def test_repeated_rows_are_hashed_into_one_set(spark):
    rng = random.Random(8)
    words = [f"w{n}" for n in range(60)]
    near = [(n, " ".join([*words[:n], "x", *words[n + 1 :]])) for n in range(1, 12)]
    rows = [(0, " ".join(words))] * 2000 + near
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    stage, prepared = Stage(spark), join._rows(df, "doc_id", "text")
    docs = stage(join._sets(prepared, 5))
    owners = docs.groupBy("sig").agg(F.min(F.xxhash64("doc_id")).alias("hash"))
    sigs = [r.sig for r in owners.collect()]
    pairs = spark.createDataFrame([(min(sigs[0], s), max(sigs[0], s)) for s in sigs[1:]], "a long, b long")
    sets = join._wanted_sets(prepared, owners, pairs, 5, stage)
    assert sets.count() == len(sigs) == 12
    got = sorted(tuple(r) for r in join.ngram_join(df).collect())
    assert got == plain_classes(rows, 5, 80, 100)
