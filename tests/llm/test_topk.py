from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfledger.llm import topk
from shelfledger.llm.common import table


def brute(ids, vectors, query, own, k):
    scores = vectors.astype(np.int64) @ query.astype(np.int64)
    found = sorted(((int(s), -int(i)) for i, s in zip(ids, scores, strict=True) if i != own), reverse=True)[:k]
    return [(s, -i) for s, i in found]


def clusters(seed, n, dim, n_clusters=12, spread=6, scale=200):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-scale, scale, (n_clusters, dim))
    return centres[rng.integers(0, n_clusters, n)] + rng.integers(-spread, spread + 1, (n, dim))


@pytest.mark.parametrize(
    ("n", "dim", "spread", "scale"), [(1, 3, 1, 5), (4, 3, 1, 5), (700, 2, 1, 3), (2000, 16, 6, 200), (1500, 64, 60, 60), (600, 8, 5, 2**24)]
)
def test_search_against_all_products(n, dim, spread, scale):
    vectors = clusters(n, n, dim, spread=spread, scale=scale)
    ids = np.random.default_rng(n).permutation(n) * 3
    tree = topk.Pages.build(ids, vectors)
    rng = np.random.default_rng(5)
    for at in range(0, n, max(1, n // 40)):
        assert tree.search(vectors[at], int(ids[at]), 5) == brute(ids, vectors, vectors[at], ids[at], 5)
        other = rng.integers(-scale, scale, dim)
        assert tree.search(other, None, 7) == brute(ids, vectors, other, None, 7)


def test_bounds_avoid_computations():
    vectors = clusters(3, 4000, 16)
    tree = topk.Pages.build(np.arange(4000), vectors)
    for at in range(0, 4000, 100):
        tree.search(vectors[at], at, 5)
    assert tree.computed < 0.3 * 40 * 4000


def test_radii_and_distances_cover():
    tree = topk.Pages.build(np.arange(900), clusters(4, 900, 5))

    def below(page):
        numbers, points, radii, _ = tree.pages[page]
        return points if radii is None else np.vstack([below(child) for child in numbers])

    for numbers, points, radii, _ in tree.pages.values():
        for n, child in enumerate(numbers if radii is not None else []):
            assert topk.distances(below(child), points[n]).max() <= radii[n] + 1e-9
            assert np.allclose(topk.distances(tree.pages[child][1], points[n]), tree.pages[child][3])


def test_equal_vectors_and_ties():
    vectors = np.ones((500, 4), np.int64)
    tree = topk.Pages.build(np.arange(500)[::-1].copy(), vectors)
    assert tree.search(vectors[0], 0, 3) == [(4, 1), (4, 2), (4, 3)]


def test_query_equals_its_sql(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_SLICE", 4)
    folder = "/root/testdata/sf0.001"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
        expected = db.execute(topk.ORACLE_SQL).fetchall()
    assert sorted(map(tuple, topk.top_k(table(spark, folder, "embeddings")).collect())) == sorted(expected)


def test_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [0.001, -0.001]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0])]
    rows += [(6, [inf, 1.0]), (None, [9.0, 9.0]), (50, [3.0]), (51, [4.0]), (100, []), (150, [1.0, 2.0, 3.0]), (7, [2.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, dim string, score int")
    got = sorted(map(tuple, topk.top_k(df).collect()))
    assert got == [(0, 1, 1, 131072), (0, 2, 7, 131072), (0, 3, 2, 0), (50, 1, 51, 786432)]
    assert topk.top_k(df.limit(0)).collect() == []
    assert topk.top_k(df.where("vec_id = 3")).collect() == []


def test_rows_of_one_id_are_dealt_to_all_trees(spark):
    """Also those with equal vectors: no tree holds many more than its share."""
    rows = spark.createDataFrame([(n, 7, [1, 2]) for n in range(2000)], "row long, vec_id long, numbers array<bigint>")
    pages = topk.build_trees(rows.withColumn("dim", F.size("numbers")), F.lit(10), 10).where("leaf")
    held = [r.n for r in pages.groupBy("block").agg(F.sum(F.size("numbers")).alias("n")).collect()]
    assert len(held) == 10 and sum(held) == 2000 and max(held) < 300


@pytest.mark.parametrize("long", [[1e17, 0.0], [1e300, 1.0], [1.2e7, 1.2e7, -1.2e7]])
def test_vectors_beyond_a_long_are_refused(spark, long):
    df = spark.createDataFrame([(0, long), (1, [1.0] * len(long))], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="long"):
        topk.top_k(df)
    fits = spark.createDataFrame([(0, [1e6, 0.5]), (1, [1e6, 1.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(fits).collect()[0].score == 256 * 10**6 * 256 * 10**6 + 128 * 256
