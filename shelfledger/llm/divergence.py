"""How far the sources of a language differ in their words, pair by pair, and in which words each stands out.

Term counts come from single-pass in-memory indexing: a task builds the postings of a block of documents (how often, and
in how many documents, a source uses a term) until its memory bound, spills them as a run sorted by term and starts anew.
The runs are dealt to hash shards, and each shard's runs are merged by a heap, some thousand terms at a time, into frequencies.

The distance of two sources sums over all terms of their language. Most terms are missing in a source, so it is taken as the
distance of two sources without any term, corrected by the terms that one of them has (counted by how often, as equal counts
correct alike) and, term by term in a stream over the merged postings, by those that both have. All numbers are whole.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfledger.llm.common import Stage

MIN_DOCUMENTS, UNIT, PRIOR, TOP_TERMS = 10, 1_000_000_000, 2, 10
#: Postings that a task holds before it spills a run; hash shards; terms of a run merged at a time.
BLOCK_POSTINGS, SHARDS, MERGED_TERMS = 500_000, 1024, 1 << 13
#: Pairs computed at a time; pairs summed in a task.
PAIR_SLICE, HELD_PAIRS = 1 << 20, 1 << 19

#: ASCII letters in lower case, other ASCII as blanks, the bytes of other characters as they are.
LETTERS = bytes(b if b > 127 else b | 32 if chr(b).isalpha() else 32 for b in range(256))

#: A run's part for one shard: distinct terms in order, separated by blanks, the number of each one's postings, and the
#: postings: place of the group in ``names`` (language, source, language, ...), occurrences, documents.
_SEGMENT = pa.schema(
    [("shard", pa.int32()), ("run", pa.int64()), ("terms", pa.binary()), *[(name, pa.binary()) for name in ("lengths", "groups", "counts", "docs")]]
    + [("names", pa.list_(pa.string()))]
)
SEGMENT = "shard int, run long, terms binary, lengths binary, groups binary, counts binary, docs binary, names array<string>"
FREQUENCY = "lang string, source string, term string, count long, docs long"


def terms(text: str) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(LETTERS).split()


class Block:
    """Postings of documents: for each language and source, occurrences and documents by term.

    The empty term stands for the source itself, so that sources without terms are known. Of documents, those beyond a
    term's first are counted, as most terms have no other.
    """

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: str) -> None:
        if (lang, source) not in self.groups:
            self.groups[lang, source] = Counter({b"": 0}), Counter()
            self.size += 1
        counts, docs = self.groups[lang, source]
        found, had = terms(text), len(counts)
        docs.update(set(found) & counts.keys())
        counts.update(found)
        self.size += len(counts) - had

    def run(self, number: int, shards: int = SHARDS) -> Iterator[pa.RecordBatch]:
        """The postings in order of term, dealt to hash shards."""
        groups = sorted(self.groups)
        found, shard, group, counts, docs = [], [], [], [], []
        for place, key in enumerate(groups):
            of_count, of_docs = self.groups[key]
            own, seed = list(of_count), zlib.crc32("\0".join(key).encode())
            found += own
            shard.append(np.array([zlib.crc32(term, seed) for term in own], np.int64) % shards)
            group.append(np.full(len(own), place, np.int32))
            counts.append(np.array(list(of_count.values()), np.int64))
            docs.append(1 + np.array(list(map(of_docs.__getitem__, own)), np.int64))
        if not found:
            return
        of_term = pa.array(found, pa.binary())
        order = pa.compute.array_sort_indices(of_term).to_numpy()  # stable, so groups stay in order
        shard = np.concatenate(shard)[order]
        by_shard = np.argsort(shard, kind="stable")
        order, shard = order[by_shard], shard[by_shard]
        of_term = of_term.take(pa.array(order))
        group, counts, docs = (np.concatenate(values)[order] for values in (group, counts, docs))
        new = np.ones(len(order), bool)
        new[1:] = (shard[1:] != shard[:-1]) | pa.compute.not_equal(of_term.slice(1), of_term.slice(0, len(order) - 1)).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(new)
        distinct = of_term.take(pa.array(begins)).to_pylist()
        lengths = np.diff(np.append(begins, len(order))).astype(np.int32)
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(order)]
        rows = []
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            low, high = np.searchsorted(begins, [begin, end])
            used, places = np.unique(group[begin:end], return_inverse=True)
            values = [int(shard[begin]), number, b" ".join(distinct[low:high]), lengths[low:high].tobytes(), places.astype(np.int32).tobytes()]
            values += [counts[begin:end].tobytes(), docs[begin:end].tobytes(), [name for place in used.tolist() for name in groups[place]]]
            rows.append(values)
            if len(rows) == 256 or end == len(order):
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), _SEGMENT.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=_SEGMENT)
                rows = []


def indexed(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_POSTINGS, shards: int = SHARDS) -> Iterator[pa.RecordBatch]:
    """The runs of a task, from rows of language, source and text."""
    number, block = TaskContext.get().partitionId() << 32, Block()
    for batch in batches:
        for lang, source, text in zip(*batch.columns, strict=True):
            block.add(lang.as_py(), source.as_py(), text.as_py())
            if block.size >= limit:
                yield from block.run(number, shards)
                number, block = number + 1, Block()
    yield from block.run(number, shards)


class Run:
    """One run's part for a shard, read from its least term on."""

    def __init__(self, row: dict, ids: dict[tuple[str, str], int]):
        self.terms = row["terms"].split(b" ")
        self.lengths = np.frombuffer(row["lengths"], np.int32)
        names = list(zip(row["names"][::2], row["names"][1::2], strict=True))
        known = np.array([ids.setdefault(name, len(ids)) for name in names], np.int64)
        self.groups = known[np.frombuffer(row["groups"], np.int32)]
        self.counts, self.docs = np.frombuffer(row["counts"], np.int64), np.frombuffer(row["docs"], np.int64)
        self.ends = np.append(0, np.cumsum(self.lengths))
        self.at = 0

    def bound(self, size: int) -> bytes:
        """The last of the next so many terms."""
        return self.terms[min(self.at + size, len(self.terms)) - 1]

    def take(self, bound: bytes, size: int) -> tuple[list[bytes], np.ndarray, slice]:
        """The terms up to a bound, the number of their postings, and where those are."""
        begin = self.at
        self.at = bisect_right(self.terms, bound, begin, min(begin + size, len(self.terms)))
        return self.terms[begin : self.at], self.lengths[begin : self.at], slice(self.ends[begin], self.ends[self.at])


def merged(runs: list[Run], size: int = MERGED_TERMS) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Term, group, occurrences and documents of all runs in order of term, equal ones added up.

    A heap holds each run by the last of its next ``size`` terms; the least of them bounds what every run can give now.
    """
    heap = [(run.bound(size), at) for at, run in enumerate(runs)]
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        parts = [(run, *run.take(bound, size)) for run in runs if run.at < len(run.terms) and run.terms[run.at] <= bound]
        while heap and heap[0][0] <= bound:
            _, at = heapq.heappop(heap)
            if runs[at].at < len(runs[at].terms):
                heapq.heappush(heap, (runs[at].bound(size), at))
        encoded = pa.array(list(chain.from_iterable(found for _, found, _, _ in parts)), pa.binary()).dictionary_encode()
        rank = np.argsort(pa.compute.array_sort_indices(encoded.dictionary).to_numpy())
        term = np.repeat(rank[encoded.indices.to_numpy()], np.concatenate([lengths for _, _, lengths, _ in parts]))
        group, counts, docs = (np.concatenate([getattr(run, name)[where] for run, _, _, where in parts]) for name in ("groups", "counts", "docs"))
        keys, place = np.unique(term.astype(np.int64) << 32 | group, return_inverse=True)
        sums = [np.zeros(len(keys), np.int64) for _ in range(2)]
        for total, values in zip(sums, (counts, docs), strict=True):
            np.add.at(total, place, values)
        in_order = encoded.dictionary.take(pa.array(np.argsort(rank)))
        yield in_order.take(pa.array(keys >> 32)), keys & 0xFFFFFFFF, *sums


def merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequencies from segments in order of shard; one shard is held at a time."""

    def flushed(runs: list[Run], ids: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([key[n] for key in ids], pa.string()) for n in range(2))
        for term, group, counts, docs in merged(runs):
            place = pa.array(group)
            columns = [langs.take(place), sources.take(place), term.cast(pa.string()), pa.array(counts), pa.array(docs)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])

    shard, runs, ids = None, [], {}
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if runs and row["shard"] != shard:
                yield from flushed(runs, ids)
                runs, ids = [], {}
            shard = row["shard"]
            runs.append(Run(row, ids))
    if runs:
        yield from flushed(runs, ids)


def frequencies(documents: DataFrame, stage: Stage, block_postings: int, shards: int) -> DataFrame:
    """``count`` and ``docs`` of each language, source and term; a row with an empty term for each language and source."""
    rows = documents.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")])
    runs = stage(rows.mapInArrow(lambda batches: indexed(batches, block_postings, shards), SEGMENT))
    return stage(runs.repartition("shard").sortWithinPartitions("shard", "run").mapInArrow(merge_shards, FREQUENCY))


def share(count: str, n: str, v: str) -> Column:
    """A term's share of a group with ``n`` occurrences, in parts of UNIT; null where its language keeps no term (``v``)."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10, 0)) * ({count} + {PRIOR})) div nullif(cast({n} as decimal(19, 0)) + 2 * {v}, 0)")


def gap(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q}))"


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What terms that two sources both have add to their distance, from rows in order of language, term and source.

    Sums stay in the task up to HELD_PAIRS pairs of sources. ``a`` sorts before ``b``.
    """
    ids: dict[tuple[str, str], int] = {}
    sums: dict[int, int] = {}
    kind = pa.int64()

    def flushed() -> pa.RecordBatch:
        names = list(ids)
        a, b = (np.array([key >> 32 for key in sums], np.int64), np.array([key & 0xFFFFFFFF for key in sums], np.int64))
        columns = [pa.array([names[n][0] for n in a], pa.string()), pa.array([names[n][1] for n in a], pa.string())]
        columns += [pa.array([names[n][1] for n in b], pa.string()), pa.array(list(sums.values()), kind)]
        sums.clear()
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    def add(rows: pa.Table) -> None:
        """Rows of whole terms."""
        lang, source = (rows.column(name).combine_chunks().dictionary_encode() for name in ("lang", "source"))
        both = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        known, group = np.unique(both, return_inverse=True)
        langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
        known = np.array([ids.setdefault((langs[n // len(sources)], sources[n % len(sources)]), len(ids)) for n in known.tolist()], np.int64)
        group = known[group]
        p, zero = (rows.column(name).to_numpy() for name in ("p", "zero"))
        ends = np.append(np.flatnonzero(new_term(rows)[1:]) + 1, rows.num_rows)
        after = ends[np.searchsorted(ends, np.arange(rows.num_rows), "right")] - 1 - np.arange(rows.num_rows)
        slices = np.searchsorted(np.cumsum(after), np.arange(0, int(after.sum()) + 1, PAIR_SLICE))
        for begin, end in zip(slices, [*slices[1:], rows.num_rows], strict=True):
            left = np.repeat(np.arange(begin, end), after[begin:end])
            first = np.cumsum(after[begin:end]) - after[begin:end]
            right = left + 1 + np.arange(len(left)) - np.repeat(first, after[begin:end])
            more = gaps(p[left], p[right]) - gaps(p[left], zero[right]) - gaps(zero[left], p[right]) + gaps(zero[left], zero[right])
            pairs, place = np.unique(group[left] << 32 | group[right], return_inverse=True)
            totals = np.zeros(len(pairs), np.int64)
            np.add.at(totals, place, more)
            for pair, total in zip(pairs.tolist(), totals.tolist(), strict=True):
                sums[pair] = sums.get(pair, 0) + total

    def new_term(rows: pa.Table) -> np.ndarray:
        """Whether a row begins a term."""
        found = np.ones(rows.num_rows, bool)
        if rows.num_rows > 1:
            same = [pa.compute.equal(rows.column(n).slice(1), rows.column(n).slice(0, rows.num_rows - 1)) for n in ("lang", "term")]
            found[1:] = ~pa.compute.and_(*same).to_numpy()
        return found

    held: list[pa.RecordBatch] = []
    for batch in batches:
        rows = pa.Table.from_batches([*held, batch])
        begin = int(np.flatnonzero(new_term(rows))[-1]) if rows.num_rows else 0
        if begin:
            add(rows.slice(0, begin))
        held = rows.slice(begin).combine_chunks().to_batches()
        if len(sums) >= HELD_PAIRS:
            yield flushed()
    if held:
        add(pa.Table.from_batches(held))
    if sums:
        yield flushed()


def audit(
    documents: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    block_postings: int = BLOCK_POSTINGS,
    shards: int = SHARDS,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every language and source of the documents.

    Part ``pair``: the distance to each other source of the language, all ranks. Part ``term``: the terms that the source
    uses more than its language does, the first ``top_terms``. A language keeps the terms of at least ``min_documents`` of
    its rows. Ties go to the item that is less in UTF-8. Null text, language and source are the empty text, which is a source
    or language as any other; repeated rows count as often as they are there; an empty table gives no row; other columns are
    ignored. A source alone in its language has no pairs, one without terms no part ``term``.

    Postings are summed in tasks before they move. A key holds one row for each run (merging), each source (a term) or each
    other source (a source), never its documents.
    """
    stage = Stage(documents.sparkSession)
    found = frequencies(documents, stage, block_postings, shards)
    of_term = Window.partitionBy("lang", "term")
    kept = found.where("term <> ''").select(
        "lang", "term", "source", "count",
        F.sum("docs").over(of_term).alias("lang_docs"),
        F.sum("count").over(of_term).alias("lang_count"),
        (F.row_number().over(of_term.orderBy("source")) == 1).cast("long").alias("first"),
    )
    kept = stage(kept.where(F.col("lang_docs") >= min_documents).drop("lang_docs"))
    langs = kept.groupBy("lang").agg(F.sum("first").alias("v"), F.sum("count").alias("lang_n"))
    groups = found.where("term = ''").select("lang", "source").join(kept.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").fillna(0, ["n", "v", "lang_n"]).withColumn("none", F.lit(0).cast("long"))
    groups = stage(groups.select("*", share("none", "n", "v").alias("zero")).drop("none"))

    with_shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "count", "zero", share("count", "n", "v").alias("p"), share("lang_count", "lang_n", "v").alias("q")
    )
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = with_shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    out = out.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top_terms)

    others = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("q"))
    pairs = groups.join(others, "lang").where("source <> item").select("lang", "source", "item", "v", "zero", "q")
    alike = with_shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n_terms"))
    one = pairs.drop("v").join(alike, ["lang", "source"]).select(
        "lang", "source", "item", F.expr(f"n_terms * ({gap('p', 'q')} - {gap('zero', 'q')})").alias("value")
    )
    one = one.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    streamed = with_shares.select("lang", "term", "source", "p", "zero").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = streamed.mapInArrow(shared_terms, "lang string, a string, b string, value long")
    none = pairs.select("lang", "source", "item", F.coalesce(F.expr(f"v * ({gap('zero', 'q')})"), F.lit(0)).cast("long").alias("value"))
    turned = [one, one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")]
    turned += [both.select("lang", F.col(x).alias("source"), F.col(y).alias("item"), "value") for x, y in ("ab", "ba")]
    values = reduce(DataFrame.unionByName, [none, *turned]).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    values = values.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(place))
    return values.unionByName(out)


ORACLE_SQL = rf"""
WITH rows AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows
), kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCUMENTS}
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM rows
), filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n,
         1 + ({UNIT}::HUGEINT * (n + {PRIOR}))
           // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM filled
), lang_shares AS (
  SELECT lang, term, 1 + ({UNIT}::HUGEINT * (sum(n) + {PRIOR}))
           // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM filled GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT
  FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM ranked
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
