"""Near duplicates among embeddings: codes by iterative quantisation, multi-index Hamming tables, exact reranking.

Rotations that bring vectors close to the corners of a cube are learned on a bounded sample; the signs of the rotated
coordinates are balanced binary codes. The code is cut into substrings, each the key of one hash table; vectors that agree
in a whole substring meet in its bucket and are compared by the cosine of their original vectors. Links are counted and
joined inside the tasks: no list of pairs leaves them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfledger.llm.common import Stage
from shelfledger.llm.graph import components
from shelfledger.llm.topk import usable

THRESHOLD = 0.9
SAMPLE, STEPS = 10_000, 30
#: Substrings of the code at least, and vectors that a bucket holds by chance; together they set recall and cost.
TABLES, BUCKET_ROWS = 16, 16
#: The share of pairs at a cosine of 0.9 that are to meet if rotations were random; learned ones find a little more.
RECALL = 0.92
#: Larger buckets are compared block by block.
BLOCK_ROWS = 1024


def substring_bits(n: int) -> int:
    """So many bits that n vectors with random codes fill buckets of BUCKET_ROWS."""
    return int(np.clip(np.ceil(np.log2(max(2, n) / BUCKET_ROWS)), 4, 28))


def tables(bits: int) -> int:
    """So many substrings of this length that RECALL is met: longer ones agree less often, so they must be more.

    Vectors at an angle fall on different sides of a random plane with probability angle / pi.
    """
    agree = (1 - np.arccos(0.9) / np.pi) ** bits
    return max(TABLES, int(np.ceil(np.log(1 - RECALL) / np.log1p(-agree))))


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.maximum(np.abs(vectors).max(1), np.finfo(np.float64).tiny)[:, None]
    return vectors / np.maximum(np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), np.finfo(np.float64).tiny)[:, None]


class Quantizer:
    """Learned rotations: ``project`` maps a unit vector to the numbers whose signs are its code."""

    def __init__(self, sample: np.ndarray, bits: int, seed: int = 0):
        self.bits, self.tables = bits, tables(bits)
        dim = sample.shape[1]
        self.mean = sample.mean(0)
        centred = sample - self.mean
        _, vectors = np.linalg.eigh(centred.T @ centred)
        axes = vectors[:, ::-1]
        rng = np.random.default_rng(seed)
        turned = centred @ axes
        found = []
        for _ in range(-(-self.tables * bits // dim)):
            rotation, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
            for _ in range(STEPS):
                corners = np.where(turned @ rotation >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(corners.T @ turned)
                rotation = (left @ right).T
            found.append(axes @ rotation)
        # Neighbouring substrings take their bits from all rotations.
        self.axes = np.column_stack(found)[:, rng.permutation(dim * len(found))[: self.tables * bits]]

    def codes(self, units: np.ndarray) -> np.ndarray:
        """For each vector the substrings of its code, as numbers."""
        centred, found = units - self.mean, []
        for at in range(0, self.tables, TABLES):  # so many at a time, to hold few signs
            axes = self.axes[:, at * self.bits : (at + TABLES) * self.bits]
            signs = (centred @ axes >= 0).reshape(len(units), axes.shape[1] // self.bits, self.bits)
            found.append((signs @ (1 << np.arange(self.bits))).astype(np.int32))
        return np.concatenate(found, 1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def fit(groups: DataFrame, counts: dict[int, int], sample: int = SAMPLE) -> dict[int, Quantizer]:
    """A quantizer for each length of vector, from about ``sample`` of them, never more than twice as many."""
    models = {}
    for dim, n in counts.items():
        part = F.pmod(F.xxhash64("vector"), F.lit(1 << 40)) < int(min(1.0, sample / n) * (1 << 40))
        rows = groups.where((F.col("dim") == dim) & part).select(F.xxhash64("vector").alias("at"), "vector").limit(2 * sample).toArrow()
        if rows.num_rows:
            units = unit(_matrix(rows.column("vector").combine_chunks(), dim))
            units = units[np.argsort(rows.column("at").to_numpy(), kind="stable")]
        else:
            units = np.eye(dim)
        models[dim] = Quantizer(units, substring_bits(n))
    return models


def links_in(vectors: np.ndarray, codes: np.ndarray, table: int, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float):
    """Compare rows ``left`` with rows ``right`` of a bucket: links of each row, and for each its class's smallest row.

    A pair counts in the first table that brings it together. ``left`` and ``right`` are the same rows or share none.
    """
    n = len(vectors)
    near = vectors[left] @ vectors[right].T >= threshold
    if len(left) == len(right) and left[0] == right[0]:
        near[np.arange(len(left)), np.arange(len(left))] = False
        near = np.triu(near)
    a, b = np.nonzero(near)
    a, b = left[a], right[b]
    first = np.ones(len(a), bool)
    for at in range(0, len(a), 1 << 16):  # a slice of pairs at a time
        part = slice(at, at + (1 << 16))
        first[part] = ~(codes[a[part], :table] == codes[b[part], :table]).any(1)
    links = np.bincount(a[first], sizes[b[first]], n) + np.bincount(b[first], sizes[a[first]], n)
    roots = np.arange(n)
    while len(a):  # hand the smaller root down both ways until nothing changes
        before = roots.copy()
        np.minimum.at(roots, a, roots[b])
        np.minimum.at(roots, b, roots[a])
        roots = roots[roots]
        if (roots == before).all():
            break
    linked = np.zeros(n, bool)
    linked[a] = linked[b] = True
    return links.astype(np.int64), roots, linked


def _compared(together: DataFrame, threshold: float) -> DataFrame:
    """node, links, root for the rows of each bucket, or pair of its blocks, that link."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """The key of each bucket, with its blocks, nodes, sizes, vectors and codes."""
        held: list[list[np.ndarray]] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(n).to_numpy() for n in range(5)])
            rest = [batch.column(n).to_numpy() for n in range(5, 8)]
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            values, codes = batch.column(8), batch.column(9)
            offsets, code_offsets = values.offsets.to_numpy(), codes.offsets.to_numpy()
            numbers, code_numbers = values.values.to_numpy(zero_copy_only=False), codes.values.to_numpy(zero_copy_only=False)
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if held and (keys[begin] != last).any():
                    yield last, [np.concatenate(parts) for parts in zip(*held, strict=True)]
                    held = []
                last = keys[begin]
                vectors = numbers[offsets[begin] : offsets[end]].reshape(end - begin, -1)
                part = code_numbers[code_offsets[begin] : code_offsets[end]].reshape(end - begin, -1)
                held.append([x[begin:end] for x in rest] + [vectors, part])
        if held:
            yield last, [np.concatenate(parts) for parts in zip(*held, strict=True)]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        waiting = 0
        for (_, table, _, low, high), (blocks, nodes, sizes, vectors, codes) in buckets(batches):
            left = np.flatnonzero(blocks == low)
            right = left if low == high else np.flatnonzero(blocks == high)
            if not len(left) or not len(right) or len(nodes) < 2:
                continue
            links, roots, linked = links_in(unit(vectors), codes, int(table), sizes, left, right, threshold)
            found.append((nodes[linked], links[linked], nodes[roots[linked]]))
            waiting += int(linked.sum())
            if waiting > 50_000 or len(found) > 5000:
                yield _batch(found)
                found, waiting = [], 0
        if found:
            yield _batch(found)

    def _batch(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(parts), pa.int64()) for parts in zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["node", "links", "root"])

    return together.mapInArrow(compare, "node bigint, links bigint, root bigint")


def _in_buckets(coded: DataFrame) -> DataFrame:
    """A row per vector and table, with its codes of the tables before, in the block pairs of its bucket; sorted by bucket."""
    keys = coded.select("dim", F.posexplode("codes").alias("table", "key"))
    large = keys.groupBy("dim", "table", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK_ROWS)
    large = large.select("dim", "table", "key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = coded.select("dim", F.posexplode("codes").alias("table", "key"), "node", "size", "vector", "codes")
    rows = rows.join(large, ["dim", "table", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = ["dim", "table", "key", "low", "high"]
    rows = rows.select(
        "dim", "table", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "size", "vector", F.slice("codes", F.lit(1), F.col("table")).alias("codes"),
    )
    return rows.repartition(*key).sortWithinPartitions(*key)


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Rows link whose vectors' cosine, in double precision, is at least ``threshold`` and whose codes agree in one of the
    substrings; none links below it. ``n_links`` counts the other rows linked with; ``component_id`` is the smallest id that
    links reach. Equal vectors are one node with its number of rows, so copies are never expanded. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing; nor do vectors of different lengths. A null id is
    carried, and repeated rows each count. ``kept`` is ``vec_id = component_id`` (also where both are null). Other columns
    are ignored.

    A bucket with very many vectors is cut into blocks by counts that are summed before they move, and every pair of
    blocks is a task's work of bounded size.
    """
    stage = Stage(vectors.sparkSession)
    vector = F.col("vector")
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    nonzero = F.exists(vector, lambda x: x != 0)
    usable_rows = rows.where(usable(vector.cast("array<double>")) & F.coalesce(nonzero, F.lit(False)))
    groups = usable_rows.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
    # The numbers are fixed by writing them.
    groups = stage(groups.select("*", F.monotonically_increasing_id().alias("node"), F.size("vector").alias("dim")))
    counts = {row.dim: row.n for row in groups.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = vectors.sparkSession.sparkContext.broadcast(fit(groups, counts))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, values = batch.column(2).to_numpy(), batch.column(3)
            offsets = np.concatenate([[0], np.cumsum([shared.value[dim].tables for dim in dims.tolist()])]).astype(np.int32)
            codes = np.zeros(offsets[-1], np.int32)
            for dim in np.unique(dims).tolist():
                at, model = np.flatnonzero(dims == dim), shared.value[dim]
                codes[offsets[at][:, None] + np.arange(model.tables)] = model.codes(unit(_matrix(values.take(pa.array(at)), dim)))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["node", "size", "dim", "vector", "codes"])

    kind = groups.schema["vector"].dataType.simpleString()
    coded = groups.select("node", "size", "dim", "vector")
    coded = stage(coded.mapInArrow(encode, f"node bigint, size bigint, dim int, vector {kind}, codes array<int>"))
    found = stage(_compared(_in_buckets(coded), threshold))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), stage)
    named = groups.join(links, "node", "left").join(classes, "node", "left")
    named = stage(
        named.select(
            "vector", "least", F.coalesce("root", "node").alias("root"),
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(smallest, "root").select("vector", "n_links", "component")
    joined = rows.join(named, "vector", "left")
    alone = F.col("n_links").isNull()
    component: Column = F.when(alone, F.col("vec_id")).otherwise(F.col("component"))
    joined = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return joined.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
