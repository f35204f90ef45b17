"""Exact self-join of documents on the Jaccard similarity of their word shingles, size-aware.

1. Texts become sets of shingle hashes; equal sets become one, known by its signature.
2. A global order of shingles puts those found in many texts last. They are found by counting the shingles whose hash lies
   in a fixed part of the hash range; the order is exact however good that guess is, it only keeps lists short.
3. Of a set of n shingles with t the threshold, any partner shares one of the first ``n - ceil(t * n) + 1`` shingles, and
   ``k`` of the first ``n - ceil(t * n) + k``. Large sets enter the inverted list of each of the former; small sets
   enumerate the pairs (k = 2) among the latter. The boundary is where both cost the same, by the counted lengths of lists.
   Sets near the boundary, which may have a partner on its other side, enter both.
4. A list is not expanded into all its pairs. First a few of its members are compared with all others, which joins the
   near copies in it. Then the members of lists that still hold several classes are compared across classes, by sketches
   and block by block inside tasks: two sets cannot share more than the sum, over the slots of a sketch, of the smaller of
   their counts. Only pairs that this leaves possible come out. So every two sets that share a key are compared unless a
   class already joins them.
5. Candidates are verified on their whole sets, which meet in tasks by the smaller signature, salted where it is in many
   pairs. Components of the verified links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfledger.llm.common import Stage
from shelfledger.llm.graph import components
from shelfledger.llm.grouping import grouped
from shelfledger.llm.shingles import mixed, shingle_sets, signature

#: Part of the hash range in which shingles are counted.
COUNTED_PART = 0.25
#: Lists shorter than this are never put last; at most this many shingles are.
LONG_LIST, MAX_LONG_LISTS = 8, 1 << 20
#: What comparing two sets costs, in rows of an index.
PAIR_COST = 2.0
LEADERS = 8
#: Longer lists are scanned block by block.
BLOCK_ROWS = 1024
#: Keys that a set carries into the scan, so that a pair comes out of one list and not of each that it shares.
CARRIED_KEYS = 64
PAIRS_PER_TASK = 2000
#: Flags of wanted ids: so many for each, between these bounds.
FLAGS_EACH, LEAST_FLAGS, MOST_FLAGS = 16, 1 << 20, 1 << 28
LARGEST_BOUNDARY = 256
MIN_SLOTS, MAX_SLOTS, FULL = 32, 8192, 255
SUBSET_MARK = np.uint64(0xA0761D6478BD642F)


class Threshold:
    """A similarity of at least ``numerator / denominator``, in whole numbers."""

    def __init__(self, numerator: int, denominator: int):
        self.numerator, self.denominator = numerator, denominator

    def prefix(self, n: int, shared: int = 1) -> int:
        """How many shingles of a set of n hold ``shared`` of those that a partner has too."""
        return min(n, n + (-self.numerator * n) // self.denominator + shared)

    def smallest_partner(self, n: int) -> int:
        return -(-self.numerator * n // self.denominator)

    def holds(self, intersection: int, a: int, b: int) -> bool:
        return self.denominator * intersection >= self.numerator * (a + b - intersection)

    def sizes_fit(self, a, b):
        return F.lit(self.denominator) * F.least(a, b) >= F.lit(self.numerator) * F.greatest(a, b)


def boundary(threshold: Threshold, partners: float) -> int:
    """The largest size for which pairs of shingles cost less than lists, if a list holds so many partners on average."""
    best = 1
    for n in range(2, LARGEST_BOUNDARY + 1):
        extended = threshold.prefix(n, 2)
        if extended * (extended - 1) / 2 > threshold.prefix(n) * (1 + PAIR_COST * partners):
            break
        best = n
    return best


def ordered(shingles: np.ndarray, limit: np.uint64, long_lists: np.ndarray, count: int) -> np.ndarray:
    """The first shingles in the global order: counted and in short lists, not counted, in long lists; each by hash."""
    counted = int(np.searchsorted(shingles, limit))
    head = shingles[:counted]
    if len(long_lists) and counted:
        found = long_lists[np.minimum(np.searchsorted(long_lists, head), len(long_lists) - 1)] == head
        head, last = head[~found], head[found]
    else:
        last = head[:0]
    if len(head) >= count:
        return head[:count]
    return np.concatenate([head, shingles[counted:], last])[:count]


def index_keys(
    shingles: np.ndarray, threshold: Threshold, edge: int, limit: np.uint64, long_lists: np.ndarray
) -> np.ndarray:
    n = len(shingles)
    small = n <= edge
    first = ordered(shingles, limit, long_lists, threshold.prefix(n, 2 if small else 1))
    keys = []
    if not small or n >= threshold.smallest_partner(edge + 1):
        keys.append(first[: threshold.prefix(n)])
    if small and len(first) > 1:
        a, b = np.triu_indices(len(first), 1)
        keys.append(mixed(first[a] * SUBSET_MARK + mixed(first[b])))
    return np.concatenate(keys) if keys else first[:0]


def _rows(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def sketch(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each slot of about two; a count of FULL says no more than that."""
    slots = int(np.clip(1 << (len(shingles) // 2).bit_length(), MIN_SLOTS, MAX_SLOTS))
    counts = np.bincount((shingles & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return np.minimum(counts, FULL).astype(np.uint8).tobytes()


def folded(sketches: np.ndarray, slots: int) -> np.ndarray:
    """The counts in fewer slots."""
    return sketches.reshape(len(sketches), -1, slots).sum(1, dtype=np.int32)


def may_hold(threshold: Threshold, a: np.ndarray, b: np.ndarray, sizes_a, sizes_b) -> np.ndarray:
    """For rows of sketches, or one and rows: whether the sets can be as similar as the threshold asks."""
    slots = min(a.shape[1], b.shape[1])
    most = np.minimum(folded(a, slots), folded(b, slots)).sum(1)
    unknown = (a == FULL).any(1) | (b == FULL).any(1)
    return unknown | (threshold.denominator * most >= threshold.numerator * (sizes_a + sizes_b - most))


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, sig and sketch (null for a text without words)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), size))
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64())]
            columns.append(pa.array([signature(s) if len(s) else None for s in sets], pa.int64()))
            columns.append(pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "sig", "sketch"])

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {doc_id}, n_shingles bigint, sig bigint, sketch binary")


def _by_slots(sketches: list[bytes]) -> dict[int, np.ndarray]:
    """Rows by the number of their slots."""
    lengths = np.array([len(x) for x in sketches])
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


def _matrix(sketches: list[bytes], rows: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(sketches[n] for n in rows.tolist()), np.uint8).reshape(len(rows), -1)


def _pruned(pairs: DataFrame, owners: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs whose sketches leave them possible."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            sizes = [batch.column(n).to_numpy() for n in (4, 5)]
            possible = np.zeros(batch.num_rows, bool)
            for left in _by_slots(a).values():
                for right in _by_slots([b[n] for n in left.tolist()]).values():
                    rows = left[right]
                    possible[rows] = may_hold(threshold, _matrix(a, rows), _matrix(b, rows), *(x[rows] for x in sizes))
            yield batch.select(["a", "b"]).filter(pa.array(possible))

    for name in ("a", "b"):
        columns = [F.col(x).alias(f"{x}_{name}") for x in ("sketch", "n")]
        pairs = pairs.join(owners.select(F.col("sig").alias(name), *columns), name)
    return pairs.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(compare, "a bigint, b bigint")


def _met_before(key: int, rows: list[dict]) -> np.ndarray:
    """Which rows of a list share a smaller key, by the keys they carry; that key's list gives the pair."""
    met = np.zeros((len(rows), len(rows)), bool)
    counts = [sum(k < key for k in row["keys"]) for row in rows]  # keys are in order
    owner = np.repeat(np.arange(len(rows)), counts)
    smaller = np.concatenate([np.empty(0, np.int64), *(row["keys"][:n] for row, n in zip(rows, counts, strict=True))])
    order = np.argsort(smaller, kind="stable")
    cuts = np.flatnonzero(np.diff(smaller[order])) + 1
    for part in np.split(owner[order], cuts):
        if len(part) > 1:
            met[np.ix_(part, part)] = True
    return met


def _across(key: tuple, rows: list[dict], threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Possible pairs of different classes in a list, or between two blocks of it."""
    number, low, high = key
    met = _met_before(number, rows)
    sigs, sizes, roots, blocks = (np.array([row[x] for row in rows]) for x in ("sig", "n", "root", "block"))
    sketches = [row["sketch"] for row in rows]
    by_slots = {n: (at, _matrix(sketches, at)) for n, at in _by_slots(sketches).items()}
    left, right = [], []
    for slots, (at, matrix) in by_slots.items():
        for n, row in enumerate(at.tolist()):
            if blocks[row] != low:
                continue
            for other_slots, (others, other) in by_slots.items():
                fits = threshold.denominator * np.minimum(sizes[others], sizes[row]) >= threshold.numerator * np.maximum(
                    sizes[others], sizes[row]
                )
                fits &= (roots[others] != roots[row]) & (blocks[others] == high) & ~met[row, others]
                if low == high:
                    fits &= sigs[others] > sigs[row]
                if fits.any():
                    possible = may_hold(threshold, matrix[n : n + 1], other[fits], sizes[row], sizes[others[fits]])
                    found = others[fits][possible]
                    left.append(np.full(len(found), sigs[row]))
                    right.append(sigs[found])
    empty = np.empty(0, np.int64)
    left, right = np.concatenate([empty, *left]), np.concatenate([empty, *right])
    return np.minimum(left, right), np.maximum(left, right)


def _scanned(members: DataFrame, owners: DataFrame, threshold: Threshold) -> DataFrame:
    """Possible pairs of different classes in the lists of members (key, sig, n, root); long lists in blocks."""
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    keys = F.slice(F.sort_array(F.collect_list("key")), 1, CARRIED_KEYS).alias("keys")
    carried = members.groupBy("sig").agg(keys).join(owners.select("sig", "sketch"), "sig")
    rows = members.join(sizes, "key").join(carried, "sig")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("sig"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    rows = rows.select("key", low, high, "sig", "n", "root", "block", "sketch", "keys")
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in grouped(batches, 3):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _across(key, table.to_pylist(), threshold)], ["a", "b"])

    return rows.mapInArrow(scan, "a bigint, b bigint")


def _long_lists(rows: DataFrame, size: int, stage: Stage) -> tuple[np.ndarray, float]:
    """The shingles to put last, in order, and the mean number of partners in a list of the others."""
    limit = np.uint64(COUNTED_PART * 2**64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s[: int(np.searchsorted(s, limit))] for s in shingle_sets(batch.column(1), size)]
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["shingle"])

    counts = rows.mapInArrow(scan, "shingle bigint").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts.where("n > 1"))
    level = F.floor(F.log2("n")).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("shingles"), F.sum("n").alias("rows"), F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs")
    )
    by_level = {row.level: row for row in levels.collect()}
    least = LONG_LIST.bit_length() - 1
    while sum(row.shingles for at, row in by_level.items() if at >= least) > MAX_LONG_LISTS:
        least += 1
    long = counts.where(F.col("n") >= F.lit(1 << least)).select("shingle").toArrow().column(0)
    rest = [row for at, row in by_level.items() if at < least]
    partners = sum(row.pairs for row in rest) / max(1, sum(row.rows for row in rest))
    return np.sort(long.to_numpy().view(np.uint64)) if len(long) else np.empty(0, np.uint64), partners


def _index(rows: DataFrame, size: int, threshold: Threshold, stage: Stage) -> DataFrame:
    """key, sig, n: the keys that different sets share."""
    long_lists, partners = _long_lists(rows, size, stage)
    edge, limit = boundary(threshold, partners), np.uint64(COUNTED_PART * 2**64)
    shared = rows.sparkSession.sparkContext.broadcast(long_lists)  # at most MAX_LONG_LISTS numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sigs, sizes = [], [], []
            for shingles in shingle_sets(batch.column(1), size):
                if len(shingles):
                    found = index_keys(shingles, threshold, edge, limit, shared.value)
                    keys.append(found.view(np.int64))
                    sigs.append(np.full(len(found), signature(shingles), np.int64))
                    sizes.append(np.full(len(found), len(shingles), np.int32))
            if keys:
                columns = [pa.array(np.concatenate(parts)) for parts in (keys, sigs, sizes)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "sig", "n"])

    index = stage(rows.mapInArrow(scan, "key bigint, sig bigint, n int"))
    shared_keys = index.groupBy("key").agg(F.min("sig").alias("least"), F.max("sig").alias("most"))
    shared_keys = shared_keys.where("least <> most").select("key")
    members = stage(index.join(shared_keys, "key", "left_semi").distinct())
    stage.forget(index)
    return members


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A flag for each hash of an id; about FLAGS_EACH times as many flags as ids, MOST_FLAGS at most."""
    flags = 1 << max(LEAST_FLAGS.bit_length() - 1, (FLAGS_EACH * ids.count()).bit_length())
    flags = min(flags, MOST_FLAGS)
    bit = F.col("hash").bitwiseAND(F.lit(flags - 1))
    words = ids.select(F.shiftright(bit, 6).cast("int").alias("word"), F.expr("shiftleft(1L, int(hash & 63))").alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most MOST_FLAGS / 64 rows
    table = np.zeros(flags // 64, np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint8)


def _wanted_sets(rows: DataFrame, owners: DataFrame, pairs: DataFrame, size: int, stage: Stage) -> DataFrame:
    """sig, shingles (as bytes) of the sets in pairs: one text of each is read again and hashed. May hold others too.

    Rows that repeat a text give one set, first in each task, then in all.
    """
    sigs = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    filtered = _filter_of(stage(owners.select("sig", "hash").join(sigs, "sig", "left_semi")))
    shared = rows.sparkSession.sparkContext.broadcast(filtered)  # MOST_FLAGS bits at most

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, given = shared.value, set()
        for batch in batches:
            place = batch.column(0).to_numpy() & (8 * len(flags) - 1)
            at = np.flatnonzero(flags[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            if len(at):
                sets = {signature(s): s for s in shingle_sets(batch.column(1).take(pa.array(at)), size)}
                new = [sig for sig in sets if sig not in given]
                given.update(new)
                columns = [pa.array(new, pa.int64()), pa.array([sets[sig].tobytes() for sig in new], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["sig", "shingles"])

    hashed = rows.select(F.xxhash64("doc_id").alias("hash"), "text")
    return hashed.mapInArrow(scan, "sig bigint, shingles binary").dropDuplicates(["sig"])


def _verified(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs that hold. Partners of one set stream past it; a set with many is in several tasks."""
    tasks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK).cast("int").alias("tasks"))
    part = F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("part")
    kept = tasks.select(F.col("a").alias("sig"), "a", part, F.lit(True).alias("own"))
    part = F.pmod(F.xxhash64("b"), "tasks").cast("int").alias("part")
    moved = pairs.join(tasks, "a").select(F.col("b").alias("sig"), "a", part, F.lit(False).alias("own"))
    together = kept.union(moved).join(sets, "sig").select("a", "part", "own", "sig", "shingles")
    together = together.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("own"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, own = None, np.empty(0, np.uint64)
        for batch in batches:
            left, right = [], []
            for n in range(batch.num_rows):
                leader, sig = batch.column(0)[n].as_py(), batch.column(3)[n].as_py()
                shingles = np.frombuffer(batch.column(4)[n].as_buffer(), np.uint64)
                if batch.column(2)[n].as_py():
                    a, own = leader, shingles.copy()
                elif a == leader:
                    places = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
                    if threshold.holds(int((own[places] == shingles).sum()), len(own), len(shingles)):
                        left.append(a)
                        right.append(sig)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return together.mapInArrow(compare, "a bigint, b bigint")


def _linked(rows: DataFrame, owners: DataFrame, pairs: DataFrame, size: int, threshold: Threshold, stage: Stage) -> DataFrame:
    return stage(_verified(pairs, _wanted_sets(rows, owners, pairs, size, stage), threshold))


def _classes(rows: DataFrame, owners: DataFrame, size: int, threshold: Threshold, stage: Stage) -> DataFrame:
    """node (a signature), root: the classes of different sets."""
    members = _index(rows, size, threshold, stage)
    place = F.row_number().over(Window.partitionBy("key").orderBy("sig"))
    leaders = members.withColumn("place", place).where(F.col("place") <= LEADERS)
    leaders = leaders.select("key", F.col("sig").alias("a"), F.col("n").alias("led"))
    pairs = members.join(leaders, "key").where(F.col("sig") > F.col("a")).where(threshold.sizes_fit(F.col("n"), F.col("led")))
    pairs = stage(_pruned(pairs.select("a", F.col("sig").alias("b")).distinct(), owners, threshold))
    links = _linked(rows, owners, pairs, size, threshold, stage)
    classes = components(links, stage)
    # In lists of up to LEADERS + 1 members, these were all pairs.
    named = members.join(classes.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.withColumn("root", F.coalesce("root", "sig"))
    held = named.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("root").alias("least"), F.max("root").alias("most"))
    several = held.where((F.col("held") > LEADERS + 1) & (F.col("least") != F.col("most"))).select("key")
    rest = stage(named.join(several, "key"))
    more = stage(_scanned(rest, owners, threshold).distinct())
    more = _linked(rows, owners, more, size, threshold, stage)
    return components(more.union(classes.select(F.col("node").alias("a"), F.col("root").alias("b"))), stage)


def ngram_join(
    documents: DataFrame,
    size: int = 5,
    numerator: int = 80,
    denominator: int = 100,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (distinct), ``component_id``.

    Two documents link when ``denominator * intersection >= numerator * union`` of their sets of ``size``-word shingles; with
    fewer words, the whole sequence is one shingle. ``component_id`` is the smallest id that links reach. A text that is
    null, empty or blank has no shingle and links with nothing. A null id is carried, and counts as a class's smallest only
    if no member has one. Repeated rows each give a row and are one class by their equal text. Other columns are ignored.
    Sets are told apart by 64-bit signatures and shingles by 64-bit hashes.
    """
    stage = Stage(documents.sparkSession)
    rows = _rows(documents, id_column, text_column)
    docs = stage(_sets(rows, size))
    owners = docs.where("sig is not null").groupBy("sig")
    owners = stage(owners.agg(F.min(F.xxhash64("doc_id")).alias("hash"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n")))
    classes = stage(_classes(rows, owners, size, Threshold(numerator, denominator), stage))
    sigs = docs.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least"))
    sigs = sigs.join(classes.withColumnRenamed("node", "sig"), "sig", "left")
    sigs = stage(sigs.select("sig", "least", F.coalesce("root", "sig").alias("root")))
    smallest = sigs.groupBy("root").agg(F.min("least").alias("component_id"))
    named = sigs.join(smallest, "root").select("sig", "component_id")
    joined = docs.join(named, "sig", "left")
    component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"))
