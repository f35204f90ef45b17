"""Exact search for the largest inner products, by best-first search in M-trees.

Vectors of whole numbers get one more coordinate that makes them all as long as the longest of their tree; then a larger
inner product with a query is a smaller Euclidean distance. Vectors are dealt into blocks of bounded size, and each block
becomes an M-tree of pages: inner pages hold pivots with their covering radii and their distances to the pivot above,
leaves hold vectors with theirs. A search visits pages in order of the least distance they allow. An entry whose stored
distance already rules it out by the triangle inequality is passed over without computing its own. Queries meet every tree
in slices of bounded size, and the best of all trees are the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfledger.llm.common import Stage
from shelfledger.llm.grouping import grouped

K, EVERY = 5, 50
BLOCK_ROWS, QUERY_SLICE = 4096, 2048
LEAF, FANOUT = 256, 16
#: No score is larger than the square of the longest vector's length.
LARGEST_SCORE = 2.0**63
#: Searches are dealt to at most so many tasks; more trees and slices share them.
MAX_TASKS = 10_000


def distances(vectors: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    gap = vectors - pivot
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


@dataclass
class Pages:
    """The pages of one tree: for each, numbers (ids or child pages), vectors, radii (of inner pages) and distances above."""

    length: float
    pages: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]] = field(default_factory=dict)
    computed: int = 0

    @staticmethod
    def build(ids: np.ndarray, vectors: np.ndarray, seed: int = 0) -> Pages:
        vectors = vectors.astype(np.float64)
        squares = np.einsum("ij,ij->i", vectors, vectors)
        longest = float(squares.max())
        tree = Pages(longest)
        points = np.column_stack([vectors, np.sqrt(longest - squares)])
        pivot, page, radius = tree._grow(ids, points, np.random.default_rng(seed), [1])
        tree.pages[0] = (np.array([page]), points[pivot : pivot + 1], np.array([radius]), np.zeros(1))
        return tree

    def _grow(self, ids: np.ndarray, points: np.ndarray, rng: np.random.Generator, free: list[int]) -> tuple[int, int, float]:
        """Store a page for these points and those below it; gives its pivot, number and covering radius."""
        pivot = int(distances(points, points.mean(0)).argmin())
        above = distances(points, points[pivot])
        page, free[0] = free[0], free[0] + 1
        if len(points) <= LEAF:
            self.pages[page] = (ids, points, None, above)
            return pivot, page, float(above.max())
        seeds = points[rng.choice(len(points), FANOUT, replace=False)]
        cell = np.stack([distances(points, seed) for seed in seeds]).argmin(0)
        if np.bincount(cell).max() > 0.9 * len(points):  # equal points, or nearly so
            cell = np.argsort(np.argsort(above, kind="stable"), kind="stable") * FANOUT // len(points)
        numbers, pivots, radii = [], [], []
        for part in np.unique(cell):
            rows = np.flatnonzero(cell == part)
            inner, child, radius = self._grow(ids[rows], points[rows], rng, free)
            numbers.append(child)
            pivots.append(rows[inner])
            radii.append(radius)
        self.pages[page] = (np.array(numbers), points[pivots], np.array(radii), above[pivots])
        return pivot, page, float(above.max())

    def search(self, query: np.ndarray, own: int | None, k: int) -> list[tuple[int, int]]:
        """The k best (score, id): the largest inner products, ties to the smaller id, without the query's own id."""
        exact = query.astype(np.float64)
        total = self.length + float(exact @ exact)
        slack = 1e-3 + 1e-6 * np.sqrt(total)
        whole = np.abs(exact).sum() * np.sqrt(self.length) < 2**52  # sums of doubles are exact
        best: list[tuple[int, int]] = []
        reach = np.inf  # no vector further than this is among the best
        waiting = [(0.0, 0, 0.0)]
        while waiting:
            least, page, to_pivot = heapq.heappop(waiting)
            if least > reach:
                break
            numbers, points, radii, above = self.pages[page]
            around = reach if radii is None else reach + radii
            near = np.flatnonzero(np.abs(to_pivot - above) <= around) if page else np.zeros(1, np.int64)
            self.computed += len(near)
            if radii is None:
                vectors = points[near, :-1]
                scores = vectors @ exact if whole else vectors.astype(np.int64) @ query
                if len(best) == k:
                    some = scores >= best[0][0]
                    near, scores = near[some], scores[some]
                for number, score in zip(numbers[near].tolist(), scores.tolist(), strict=True):
                    if number != own:
                        entry = (int(score), -number)
                        if len(best) < k:
                            heapq.heappush(best, entry)
                        elif entry > best[0]:
                            heapq.heapreplace(best, entry)
                if len(best) == k:
                    reach = np.sqrt(max(0.0, total - 2.0 * best[0][0])) + slack
            else:
                away = np.sqrt(np.maximum(0.0, total - 2.0 * (points[near, :-1] @ exact)))
                for child, distance, radius in zip(numbers[near].tolist(), away.tolist(), radii[near].tolist(), strict=True):
                    bound = max(0.0, distance - radius - slack)
                    if bound <= reach:
                        heapq.heappush(waiting, (bound, child, distance))
        return [(score, -number) for score, number in sorted(best, reverse=True)]


def usable(vector: Column) -> Column:
    """Neither null nor empty, and without a component that is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def quantized(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, numbers = floor(256 * x) in double precision, dim, square of the length; without rows that take no part."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    numbers = F.transform("vector", lambda x: F.floor(x * 256.0).cast("long"))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + F.pow(F.abs(x) * 256.0 + 1, 2))
    return rows.select("vec_id", numbers.alias("numbers"), F.size("vector").alias("dim"), square.alias("square"))


PAGE = "dim int, block int, page int, leaf boolean, numbers array<bigint>, points binary, radii binary, above binary"


def build_trees(rows: DataFrame, blocks: Column, n_blocks: int) -> DataFrame:
    """The pages of a tree for each block of each dimension. Rows are dealt by their numbers too, as many may have one id."""
    block = F.pmod(F.xxhash64("vec_id", "numbers", "row"), blocks).cast("int")
    dealt = rows.select("dim", block.alias("block"), "vec_id", "numbers")
    dealt = dealt.repartition(min(n_blocks, MAX_TASKS), "dim", "block").sortWithinPartitions("dim", "block", "vec_id")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, block), table in grouped(batches, 2):
            vectors = table.column("numbers").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            tree = Pages.build(table.column("vec_id").to_numpy(), vectors)
            for page, (numbers, points, radii, above) in tree.pages.items():
                stored = radii if page else np.array([radii[0], tree.length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([block], pa.int32()), pa.array([page], pa.int32())]
                    + [pa.array([radii is None]), pa.array([numbers], pa.list_(pa.int64()))]
                    + [pa.array([x.tobytes() if x is not None else None], pa.binary()) for x in (points, stored, above)],
                    ["dim", "block", "page", "leaf", "numbers", "points", "radii", "above"],
                )

    return dealt.mapInArrow(build, PAGE)


def search_trees(pages: DataFrame, queries: DataFrame, k: int, tasks: int) -> DataFrame:
    """query_id, vec_id, score: each query's best of each tree. Pages and queries come with dim, block and slice."""
    kinds = {"page": "int", "leaf": "boolean", "points": "binary", "radii": "binary", "above": "binary"}
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
    left = pages.select("dim", "block", "slice", F.lit(None).cast("long").alias("query_id"), "numbers", *kinds)
    right = queries.select("dim", "block", "slice", "query_id", "numbers", *nothing)
    together = left.union(right).repartition(tasks, "dim", "block", "slice")
    together = together.sortWithinPartitions("dim", "block", "slice", F.col("query_id").asc_nulls_first(), "page")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, _, _), table in grouped(batches, 3):
            tree, found = Pages(0.0), []
            for row in (r for batch in table.to_batches(256) for r in batch.to_pylist()):
                if row["query_id"] is None:
                    radii, above = (np.frombuffer(row[x]) if row[x] is not None else None for x in ("radii", "above"))
                    if row["page"] == 0:
                        radii, tree.length = radii[:1], float(radii[1])
                    points = np.frombuffer(row["points"]).reshape(-1, dim + 1)
                    tree.pages[row["page"]] = (np.array(row["numbers"]), points, radii, above)
                elif tree.pages:
                    query = np.array(row["numbers"], np.int64)
                    found += [(row["query_id"], vec_id, score) for score, vec_id in tree.search(query, row["query_id"], k)]
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return together.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")


def top_k(
    vectors: DataFrame, k: int = K, every: int = EVERY, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each vector whose id is divisible by ``every``, the k best others.

    The score is the inner product of the vectors' numbers ``floor(256 * x)``; ties go to the smaller id; fewer rows where
    there are fewer others. Vectors that are null, empty or hold a null or non-finite component, and those with a null id,
    take no part. Only vectors of one length are compared. Rows with the query's id are its own; repeated ids are one query,
    by the smallest of their vectors, but as many candidates as rows. Vectors so long that a score may not fit into a long are
    refused (ValueError). Other columns are ignored.
    """
    stage = Stage(vectors.sparkSession)
    # The row numbers are fixed by writing them.
    rows = stage(quantized(vectors, id_column, vector_column).withColumn("row", F.monotonically_increasing_id()))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("dim", "vec_id").agg(F.min("numbers").alias("numbers"))
    asked = stage(asked.withColumnRenamed("vec_id", "query_id"))
    # One row for each length of vector.
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("square"))
    sizes = sizes.join(asked.groupBy("dim").agg(F.count(F.lit(1)).alias("asked")), "dim").collect()
    if any(row.square >= LARGEST_SCORE for row in sizes):
        raise ValueError("the inner products of these vectors may not fit into a long")
    blocks = {row.dim: -(-row.n // BLOCK_ROWS) for row in sizes}
    slices = {row.dim: -(-row.asked // QUERY_SLICE) for row in sizes}

    def by_dim(counts: dict[int, int]) -> Column:
        found = F.lit(1)
        for dim, n in counts.items():
            found = F.when(F.col("dim") == dim, F.lit(n)).otherwise(found)
        return found

    used = rows.where(F.col("dim").isin(*blocks)) if blocks else rows.limit(0)
    pages = stage(build_trees(used, by_dim(blocks), max(1, sum(blocks.values()))))
    numbered = F.explode(F.sequence(F.lit(0), by_dim(slices) - 1)).alias("slice")
    copies = pages.select("*", numbered)
    every_block = F.explode(F.sequence(F.lit(0), by_dim(blocks) - 1)).alias("block")
    slice_of = F.pmod(F.xxhash64("query_id"), by_dim(slices)).cast("int").alias("slice")
    sent = asked.select("dim", slice_of, "query_id", "numbers", every_block)
    tasks = min(MAX_TASKS, max(1, sum(blocks[dim] * slices[dim] for dim in blocks)))
    found = search_trees(copies, sent, k, tasks)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
WITH numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, len(embedding) AS dim
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM numbers q JOIN numbers c ON q.dim = c.dim AND q.vec_id <> c.vec_id
  WHERE q.vec_id % {EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
