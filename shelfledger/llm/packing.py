"""Best-two-fit packing of token pieces into sequences of a fixed capacity.

Only piece lengths matter to a packing, and there are at most ``capacity`` of them. So the job counts pieces by length,
packs the counts (fill greedily, then replace a bin's smallest document with two unpacked ones that fit its expanded gap
more tightly), and repeats each bin found as often as the counts allow. The plan has a few thousand entries however large
the corpus is. Each piece then finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache
from math import isqrt

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from shelfledger.llm.common import Stage

CAPACITY = 1024
END_ID = 2
# Fixed value: how byte-level vocabularies of this kind split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoding(vocabulary: str) -> tiktoken.Encoding:
    """A byte-level BPE vocabulary file as an encoder; ``encode_all`` gives the ids that the file gives.

    The file writes each byte as a printable character: itself if printable, else the next one from 256 on.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {token["content"]: token["id"] for token in content.get("added_tokens", [])}
    ranks = {
        bytes(byte_of[char] for char in token): rank
        for token, rank in content["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(vocabulary, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encode_all(vocabulary: str, text: str) -> list[int]:
    """The ids of a whole text; the strings of added tokens are those tokens."""
    return encoding(vocabulary).encode(text, allowed_special="all")


def cuts(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document start: only longer ones are cut, and the first piece may be shorter."""
    return [0, *range((length - 1) % capacity + 1, length, capacity)] if length > capacity else [0]


def token_pieces(
    documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Tokenize whole texts, append the end token and cut: a row per piece with doc_id, piece, start, length, ids_crc32, ids."""
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for at, text in enumerate(batch.column(1)):
                tokens = np.array([*encode_all(vocabulary, text.as_py()), end_id], "<u4")
                begins = cuts(len(tokens), capacity)
                for piece, (begin, end) in enumerate(zip(begins, [*begins[1:], len(tokens)], strict=True)):
                    part = tokens[begin:end]
                    owners.append(at)
                    pieces.append(piece)
                    starts.append(begin)
                    lengths.append(end - begin)
                    sums.append(zlib.crc32(part.tobytes()))
                    ids.append(part.astype(np.int32) if with_ids else None)
            columns = [batch.column(0).take(pa.array(owners, pa.int64())), pa.array(pieces, pa.int32())]
            columns += [pa.array(values, pa.int64()) for values in (starts, lengths, sums)]
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"
    return rows.mapInArrow(tokenize, schema)


class Free:
    """Unpacked documents by length, with the lengths that are left in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = Counter({length: n for length, n in counts.items() if n > 0})
        self.lengths = sorted(self.counts)

    def largest(self, most: int, used: Counter) -> int | None:
        """The longest document of at most this length that the bin does not hold already."""
        at = bisect_right(self.lengths, most) - 1
        while at >= 0 and used[self.lengths[at]] >= self.counts[self.lengths[at]]:
            at -= 1
        return self.lengths[at] if at >= 0 else None

    def tightest_pair(self, most: int, used: Counter) -> tuple[int, int] | None:
        """The two documents with the largest sum of at most this length."""
        left = [n for n in self.lengths[: bisect_right(self.lengths, most)] if used[n] < self.counts[n]]
        best, low, high = None, 0, len(left) - 1
        while low <= high:
            total = left[low] + left[high]
            if total > most:
                high -= 1
                continue
            if low < high or self.counts[left[low]] - used[left[low]] >= 2:
                if best is None or total > sum(best):
                    best = (left[high], left[low])
            low += 1
        return best

    def take(self, used: Counter, times: int) -> None:
        for length, n in used.items():
            self.counts[length] -= n * times
            if not self.counts[length]:
                self.lengths.remove(length)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins as lengths in falling order, each with the number of times it is used."""
    free, bins = Free(counts), []
    while free.lengths:
        held, used, gap = [], Counter(), capacity
        while gap and (length := free.largest(gap, used)) is not None:
            held.append(length)
            used[length] += 1
            gap -= length
        while gap and len(held) > 1:
            smallest = held[-1]
            used[smallest] -= 1
            pair = free.tightest_pair(gap + smallest, used)
            if pair is None or sum(pair) <= smallest:
                used[smallest] += 1
                break
            used.update(pair)
            gap += smallest - sum(pair)
            held = sorted([*held[:-1], *pair], reverse=True)
        used = +used
        times = min(free.counts[length] // n for length, n in used.items())
        free.take(used, times)
        bins.append((held, times))
    return bins


def places(bins: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks that go to one slot of one bin: first rank, times, first sequence, first offset."""
    runs, next_rank, sequence = [], Counter(), 0
    for held, times in bins:
        offset = 0
        for length, copies in Counter(held).items():  # in falling order, as they lie
            runs.append((length, next_rank[length], times, sequence, offset))
            next_rank[length] += times * copies
            offset += length * copies
        sequence += times
    runs.sort()
    names = ("length", "rank", "times", "sequence", "offset")
    return {name: np.array([run[n] for run in runs], np.int64) for n, name in enumerate(names)}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces with ``doc_id``, ``piece`` and ``length``.

    Sequences hold at most ``capacity`` tokens, without gaps from 0. Pieces of one length are ranked in buckets of a hash
    of their keys; a bucket's first rank is the number of pieces in the buckets before it. So a length that most pieces
    share is spread over tasks. What the driver sees is one count per length. An empty table gives an empty one; equal
    rows each get a place of their own.
    """
    spark = pieces.sparkSession
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = places(best_two_fit(counts, capacity))
    buckets = isqrt(sum(counts.values())) + 1  # as many as a bucket holds of the most frequent length at most
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = [name for name in ("doc_id", "piece", "start", "ids_crc32") if name in pieces.columns]
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order))
    ranked = keyed.withColumn("inside", inside).join(firsts, ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("first") + F.col("inside") - 1).alias("rank"))
    shared = spark.sparkContext.broadcast(plan)  # at most a run per bin and length in it: bounded by the capacity
    columns = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        keys = (runs["length"] << 44) + runs["rank"]
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            run = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            copy, turn = np.divmod(rank - runs["rank"][run], runs["times"][run])
            found = [runs["sequence"][run] + turn, runs["offset"][run] + copy * length]
            kept = [batch.column(batch.schema.get_field_index(name)) for name in columns]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, found)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Tokenize all documents and pack their pieces: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    A null text is empty: its one piece is the end token. Null and repeated ids are carried; each row is packed. Other
    columns are ignored. Texts are tokenized once; the pieces are written under ``spark.checkpoint.dir`` and read again.
    """
    pieces = token_pieces(documents, vocabulary, capacity, end_id, with_ids)
    return pack(Stage(documents.sparkSession)(pieces if with_ids else pieces.drop("ids")), capacity)
