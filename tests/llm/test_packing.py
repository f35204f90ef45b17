from __future__ import annotations

import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from shelfledger.llm import packing
from shelfledger.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = Tokenizer.from_file(VOCABULARY)
REFERENCE.encode_special_tokens = True


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=80))
def test_ids_equal_those_of_the_vocabulary_file(text):
    assert packing.encoding(VOCABULARY).encode_ordinary(text) == REFERENCE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a  b \n\n\t c d", "it's I'LL 12³ x_y", "<|endoftext|>", "é" * 5000, "ab" * 3000, "‍👩‍👧", "\r\n \x85"])
def test_odd_texts(text):
    assert packing.encoding(VOCABULARY).encode_ordinary(text) == REFERENCE.encode(text, add_special_tokens=False).ids


AS_IN_FILE = Tokenizer.from_file(VOCABULARY)
ADDED = st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a", "é", "12", "'s"]), max_size=12)


@settings(deadline=None)
@given(ADDED.map("".join))
def test_added_tokens_equal_those_of_the_vocabulary_file(text):
    assert packing.encode_all(VOCABULARY, text) == AS_IN_FILE.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_documents(spark):
    text = "a <|endoftext|> b"
    (row,) = packing.pack_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), VOCABULARY).collect()
    ids = [*AS_IN_FILE.encode(text, add_special_tokens=False).ids, 2]
    assert list(row.ids) == ids == [64, 220, 50256, 275, 2]
    assert (row.length, row.ids_crc32) == (5, zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_long_words_are_not_quadratic():
    began = time.time()
    packing.encoding(VOCABULARY).encode_ordinary("ab" * 500_000)
    assert time.time() - began < 20


def test_cuts():
    assert packing.cuts(1, 4) == [0] and packing.cuts(4, 4) == [0]
    assert packing.cuts(5, 4) == [0, 1] and packing.cuts(8, 4) == [0, 4] and packing.cuts(11, 4) == [0, 3, 7]


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=30))
def test_bins_hold_each_document_once(counts):
    bins = packing.best_two_fit(counts, 50)
    assert all(sum(held) <= 50 and times > 0 for held, times in bins)
    total = Counter()
    for held, times in bins:
        for length in held:
            total[length] += times
    assert total == Counter(counts)


def test_two_documents_replace_the_smallest():
    assert packing.best_two_fit({60: 1, 35: 1, 20: 2}, 100) == [([60, 20, 20], 1), ([35], 1)]


def test_bins_are_few():
    counts = Counter(np.random.default_rng(1).integers(1, 1025, 20_000).tolist())
    used = sum(times for _, times in packing.best_two_fit(counts, 1024))
    assert used <= 1.005 * sum(length * n for length, n in counts.items()) / 1024


def check(rows, expected_ids, capacity):
    """Every id of every document lies once, in order; sequences are gapless and no longer than the capacity."""
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_document[r.doc_id].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, ids in expected_ids.items():
        at = 0
        for n, r in enumerate(sorted(by_document[doc_id], key=lambda r: r.piece)):
            part = np.array(ids[at : at + r.length], "<u4")
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(part.tobytes()))
            assert r.length == capacity or n == 0
            at += r.length
        assert at == len(ids)


def test_documents_round_trip(spark):
    source = table(spark, "/root/testdata/sf0.001", "documents")
    rows = packing.pack_documents(source, VOCABULARY, with_ids=False).collect()
    ids = {r.doc_id: [*REFERENCE.encode(r.text or "", add_special_tokens=False).ids, 2] for r in source.collect()}
    check(rows, ids, 1024)
    assert len({r.sequence_id for r in rows}) <= sum(map(len, ids.values())) / 1024 * 1.01 + 1


def test_other_capacity_and_ids(spark):
    source = table(spark, "/root/testdata/sf0.001", "documents")
    rows = packing.pack_documents(source, VOCABULARY, capacity=64).collect()
    check(rows, {r.doc_id: [*REFERENCE.encode(r.text or "", add_special_tokens=False).ids, 2] for r in source.collect()}, 64)
    assert all(len(r.ids) == r.length for r in rows)


def test_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (3, "", "y"), (4, "word " * 5000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    got = packing.pack_documents(df, VOCABULARY, capacity=16).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert sorted(r.length for r in got if r.doc_id != 4) == [1, 1, 3, 3]
    assert sum(r.length for r in got if r.doc_id == 4) == 5002
    assert packing.pack_documents(df.limit(0), VOCABULARY).collect() == []
