from __future__ import annotations

import numpy as np
import pytest

from shelfledger.llm import itq
from shelfledger.llm.common import table


def brute(vectors, threshold=0.9):
    units = itq.unit(vectors)
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    return near


def classes(near, ids):
    least = np.array(ids)
    while True:
        after = np.minimum(least, np.where(near, least, np.iinfo(np.int64).max).min(1))
        if (after == least).all():
            return least
        least = after


def pairs_at(rng, n, dim, cosine):
    """Vectors and partners at just this cosine, among others."""
    a = itq.unit(rng.normal(size=(n, dim)))
    noise = rng.normal(size=(n, dim))
    noise = itq.unit(noise - np.einsum("ij,ij->i", noise, a)[:, None] * a)
    return a, cosine * a + np.sqrt(1 - cosine**2) * noise


@pytest.mark.parametrize(("cosine", "recall"), [(0.901, 0.9), (0.93, 0.97), (0.98, 0.999)])
def test_recall_of_the_tables(cosine, recall):
    rng = np.random.default_rng(1)
    a, b = pairs_at(rng, 20_000, 64, cosine)
    model = itq.Quantizer(np.vstack([a, b])[::4], itq.substring_bits(40_000))
    found = (model.codes(a) == model.codes(b)).any(1).mean()
    assert found >= recall
    codes = model.codes(a)
    by_chance = np.mean([np.bincount(codes[:, t]).max() for t in range(itq.TABLES)])
    assert by_chance < 40 * itq.BUCKET_ROWS


@pytest.mark.parametrize("n", [131_072, 10**6, 10**8, 10**10])
def test_recall_at_any_size(n):
    a, b = pairs_at(np.random.default_rng(4), 2000, 64, 0.901)
    model = itq.Quantizer(np.vstack([a, b])[::4], itq.substring_bits(n))
    assert (model.codes(a) == model.codes(b)).any(1).mean() >= 0.9


def test_more_tables_for_one_length_than_for_another(spark, monkeypatch):
    monkeypatch.setattr(itq, "substring_bits", lambda n: 16 if n > 100 else 4)
    rng = np.random.default_rng(5)
    rows = []
    for dim, pairs in ((64, 200), (24, 30)):
        near = np.vstack(pairs_at(rng, pairs, dim, 0.99))
        rows += [(1000 * dim + n % pairs + 500 * (n >= pairs), v.tolist()) for n, v in enumerate(near)]
    got = {r.vec_id: r for r in itq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert itq.tables(16) > itq.tables(4) == itq.TABLES
    assert all(got[i].n_links == 1 and got[i].component_id == i - 500 * (i % 1000 >= 500) for i, _ in rows)


def test_codes_are_balanced():
    rng = np.random.default_rng(2)
    units = itq.unit(rng.normal(size=(5000, 32)) + 0.5)
    model = itq.Quantizer(units, 8)
    share = ((units - model.mean) @ model.axes >= 0).mean(0)
    assert abs(share - 0.5).max() < 0.08


def test_given_embeddings_with_near_copies_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK_ROWS", 40)
    given = table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").orderBy("vec_id").toPandas()
    rng = np.random.default_rng(4)
    vectors = np.stack(given.embedding)[::2].astype(np.float64)
    noise = rng.normal(size=vectors.shape)
    noise *= (np.linalg.norm(vectors, axis=1) * rng.uniform(0.1, 0.55, len(vectors)) / np.linalg.norm(noise, axis=1))[:, None]
    copies = [(10_000 + n, v.tolist()) for n, v in enumerate((vectors + noise).astype(np.float32))]
    rows = [(int(i), list(map(float, v))) for i, v in zip(given.vec_id, given.embedding, strict=True)] + copies
    rows = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    source = rows.orderBy("vec_id").toPandas()
    near = brute(np.stack(source.embedding))
    got = itq.near_duplicates(rows).orderBy("vec_id").toPandas()
    links, expected = got.n_links.to_numpy(), near.sum(1)
    assert (links <= expected).all() and links.sum() >= 0.99 * expected.sum() > 0
    if (links == expected).all():
        assert (got.component_id.to_numpy() == classes(near, source.vec_id)).all()
    assert (got.kept == (got.vec_id == got.component_id)).all()


@pytest.mark.parametrize("block_rows", [1024, 30])
def test_groups_copies_and_blocks(spark, monkeypatch, block_rows):
    monkeypatch.setattr(itq, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 24))
    vectors = [base[n % 40] + rng.normal(size=24) * 0.02 for n in range(300)] + [base[0]] * 100 + [2.0 * base[1]]
    vectors = np.array(vectors, np.float32)
    ids = (rng.permutation(len(vectors)) + 10).tolist()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in itq.near_duplicates(df).collect()}
    near = brute(vectors)
    assert [got[i].n_links for i in ids] == near.sum(1).tolist()
    assert [got[i].component_id for i in ids] == classes(near, ids).tolist()


def test_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [2.0, 0.1]), (None, [1.0, 0.0]), (7, None), (8, [0.0, 0.0]), (9, [nan, 1.0])]
    rows += [(10, [None, 1.0]), (11, [inf, 1.0]), (12, []), (13, [1.0]), (14, [-1.0, 0.0]), (None, None), (15, [1e-30, 0.0]), (16, [3e38, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, n_links int, vector string")
    got = sorted((tuple(r) for r in itq.near_duplicates(df).collect()), key=str)
    expected = [(5, 5, 3, False), (5, 5, 3, False), (3, 5, 3, True), (None, 5, 3, False), (15, 5, 3, False), (16, 5, 3, False)]
    expected += [(i, 0, i, True) for i in (7, 8, 9, 10, 11, 12, 13, 14, None)]
    assert got == sorted(expected, key=str)
    assert itq.near_duplicates(df.limit(0)).collect() == []
