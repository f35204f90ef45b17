from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, strategies as st

from shelfledger.llm import pieces, queries
from shelfledger.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "  ", "a ", " a", "a  b", "▁", "▁▁a", "a▁ b", "\n", "a\n b\t c ", "<s> x </s>", "<0x0A>", "日本語  x", "\x00 a", "é ﬁ 😀 ", "a　b"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert pieces.segmenter(MODEL).encode(text) == LIBRARY.encode(text)


@given(st.text(alphabet="ab ▁\n\té日😀<>.", max_size=60) | st.text(max_size=40))
def test_equals_the_library(text):
    own = pieces.segmenter(MODEL)
    ids = own.encode(text)
    assert ids == LIBRARY.encode(text) and own.decode(ids) == LIBRARY.decode(ids)


def test_each_distinct_chunk_is_segmented_once():
    own = pieces.Segmenter(MODEL)
    assert own.encode("one two one two one " * 1000) == LIBRARY.encode("one two one two one " * 1000)
    assert own.segmented == 2


def test_a_full_table_starts_anew():
    own = pieces.Segmenter(MODEL, table_chunks=10)
    for n in range(50):
        text = " ".join(f"word{at % 7}" for at in range(n, n + 3))
        assert own.encode(text) == LIBRARY.encode(text) and len(own.table) + len(own.old) <= 28
    long = "x" * 5000
    assert own.encode(f"{long} {long}") == LIBRARY.encode(f"{long} {long}") and all(len(c) < 5000 for c in own.table)


def test_pieces_that_cross_marks_need_whole_texts():
    own = pieces.Segmenter(MODEL)
    assert own.by_chunk
    assert pieces.CROSSING.search("of▁the") and not pieces.CROSSING.search("▁▁the")
    own.by_chunk = False
    assert own.encode("of the a ") == LIBRARY.encode("of the a ") and own.segmented == 0


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r[1:] for r in queries.op12_pieces(spark, folder).collect()}
    rows = table(spark, folder, "documents").collect()
    for row in rows:
        ids = LIBRARY.encode(row.text or "")
        assert found[row.doc_id] == (len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids)))
    assert len(found) == len(rows)


def test_odd_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, ids string, decoded int"
    long = "ab " * 200_000
    rows = [(1, None, "x", 1), (None, "a b", None, None), (1, "", "y", 2), (2, "a b", "z", 3), (2, "a b", "z", 3), (3, long, "", 0)]
    documents = spark.createDataFrame(rows, schema)
    found = pieces.decode(pieces.encode(documents, MODEL), MODEL)
    assert found.columns == ["doc_id", "ids", "decoded"]
    wanted = [(i, LIBRARY.encode(t or ""), t or "") for i, t, *_ in rows]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, wanted))
    assert pieces.digests(documents.limit(0), MODEL).collect() == []
