"""SentencePiece ids of whole texts by a table of distinct marked words, and back to text.

A model marks white space with ``▁``. If none of its pieces holds a mark after another character, no merge crosses the
border in front of a run of marks, so a text's ids are those of its chunks, one after the other: a chunk is a run of marks
with what follows up to the next one. Each task keeps a table of the distinct chunks that it met, segments each of them once
and joins the ids back by position. The table is bounded (``TABLE_CHUNKS``), so a task's memory does not grow with its rows,
and texts are never moved: a table shared by all tasks would cost a shuffle of every word that occurs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
CROSSING = re.compile(f"[^{MARK}]{MARK}")
#: Chunks in each of a task's two tables; longer chunks than LONG_CHUNK are not kept.
TABLE_CHUNKS, LONG_CHUNK = 1 << 17, 1 << 8
#: Characters of texts that are segmented together.
GROUP_CHARS = 1 << 19
#: Ids are returned in batches of about so many.
BATCH_IDS = 1 << 19


class Segmenter:
    """Encodes texts exactly as the library does, each distinct chunk once while it is in the table.

    A full table becomes the old one and a new one begins; what is met again moves over, so frequent chunks always stay.
    """

    def __init__(self, model: str, table_chunks: int = TABLE_CHUNKS):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.limit, self.table, self.old = table_chunks, {}, {}
        pieces = map(self.library.id_to_piece, range(len(self.library)))
        #: Whether chunks can be segmented one by one; otherwise whole texts are.
        self.by_chunk = not any(CROSSING.search(piece) for piece in pieces)
        mark = self.library.piece_to_id(MARK)
        if not self.library.is_unknown(mark):
            self.table[MARK] = [mark]
        self.segmented = 0

    def _segment(self, chunks: list[str]) -> dict[str, list[int]]:
        """The ids of chunks; those to which no text by itself is normalized are left out."""
        found = {}
        for cut in (1, 0):  # the library puts a mark in front of a text
            left = [chunk for chunk in chunks if chunk not in found and len(chunk) > cut]
            texts = [chunk[cut:] for chunk in left]
            fits = [normal == chunk for normal, chunk in zip(self.library.normalize(texts), left, strict=True)] if left else []
            left, texts = ([x for x, fit in zip(xs, fits, strict=True) if fit] for xs in (left, texts))
            found |= zip(left, self.library.encode(texts, num_threads=1) if texts else [], strict=True)
        self.segmented += len(found)
        return found

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; the chunks that are new in about GROUP_CHARS of texts are segmented in one call."""
        if not self.by_chunk:
            yield from map(self.library.encode, texts)
            return
        group, size = [], 0
        for at, text in enumerate(texts, 1):
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS or at == len(texts):
                yield from self._group(group)
                group, size = [], 0

    def _group(self, texts: list[str]) -> Iterator[list[int]]:
        chunks = [CHUNK.findall(self.library.normalize(text)) for text in texts]
        parts = [list(map(self.table.get, found)) for found in chunks]
        missing = {chunk for found, ids in zip(chunks, parts, strict=True) if None in ids for chunk, own in zip(found, ids, strict=True) if own is None}
        known = {chunk: ids for chunk in missing if (ids := self.old.get(chunk))}
        known |= self._segment([chunk for chunk in missing if chunk not in known]) if len(known) < len(missing) else {}
        for text, found, ids in zip(texts, chunks, parts, strict=True):
            if None in ids:
                ids = [own or known.get(chunk) for chunk, own in zip(found, ids, strict=True)]
            yield self.library.encode(text) if None in ids else list(chain.from_iterable(ids))
        if len(self.table) > self.limit:
            self.table, self.old = {}, self.table
        self.table.update((chunk, ids) for chunk, ids in known.items() if len(chunk) <= LONG_CHUNK)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@cache
def segmenter(model: str) -> Segmenter:
    """This process's segmenter for a model file."""
    return Segmenter(model)


def texts_of(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )


def encode(documents: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``ids``, the whole text's ids without begin or end ids.

    A null or empty text has no ids; a null id is carried; repeated rows each give a row; other columns are ignored. A text
    of any length is one row. One pass, without a shuffle; ``model`` must lie at the same path on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model)
        for batch in batches:
            begin, rows, size = 0, [], 0
            for at, found in enumerate(own.encode_all(batch.column(1).to_pylist()), 1):
                rows.append(found)
                size += len(rows[-1])
                if size >= BATCH_IDS or at == batch.num_rows:
                    ids = pa.array(rows, pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, at - begin), ids], ["doc_id", "ids"])
                    begin, rows, size = at, [], 0

    rows = texts_of(documents, id_column, text_column)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the text of the ids; null ids give an empty text. Repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model)
        for batch in batches:
            texts = pa.array([own.decode(ids.as_py() or []) for ids in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digests(documents: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, and SHA-256 of the ids as comma-joined decimals and of the text decoded from them.

    Rows as in ``encode``; ids and texts do not leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model)
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for ids in own.encode_all(batch.column(1).to_pylist()):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_texts.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = texts_of(documents, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
