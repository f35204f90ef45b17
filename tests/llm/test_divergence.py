from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, strategies as st

from shelfledger.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall(text.translate(LOWER))


@given(st.text(max_size=80))
def test_terms_equal_the_pattern(text):
    assert [term.decode() for term in divergence.terms(text)] == plain_terms(text)


def plain(rows, min_documents, top):
    """The audit as its definition reads, over all terms of every pair."""
    rows = [tuple(value or "" for value in row) for row in rows]
    docs, counts = Counter(), {}
    for lang, source, text in rows:
        found = plain_terms(text)
        docs.update({(lang, term) for term in found})
        counts.setdefault((lang, source), Counter()).update(found)
    out = set()
    for lang in {lang for lang, _ in counts}:
        kept = [term for (of, term), n in docs.items() if of == lang and n >= min_documents]
        groups = {source: c for (of, source), c in counts.items() if of == lang}

        def shares(count, kept=kept):
            n = sum(count[term] for term in kept)
            return {term: 1 + 10**9 * (count[term] + 2) // (n + 2 * len(kept)) for term in kept}

        p = {source: shares(count) for source, count in groups.items()}
        q = shares(sum(groups.values(), Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for source in groups:
            pairs = [(other, sum(gap(p[source][t], p[other][t]) for t in kept)) for other in groups if other != source]
            terms = [(t, gap(p[source][t], q[t])) for t in kept if groups[source][t] and p[source][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, source, part, *item, n) for n, item in enumerate(ranked, 1) if part == "pair" or n <= top}
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


WORDS = ["alpha", "Alpha", "beta", "x1y", "it's", "é", "É", "日本", "gamma", "delta", "eta", "theta"]


def made(n, seed):
    import random

    chance = random.Random(seed)
    for at in range(n):
        text = " ".join(chance.choice(WORDS[: 3 + at % 10]) for _ in range(chance.randrange(12)))
        yield chance.choice(["en", "de", "", None]), f"s{int(chance.random() ** 2 * 5)}", chance.choice([text, text, text, None])


@pytest.mark.parametrize("block, shards", [(500_000, 1024), (7, 3)])
def test_against_all_terms_of_all_pairs(spark, block, shards):
    rows = [*made(200, 1), ("fr", "alone", "un deux"), ("it", "a", ""), ("it", "b", None), (None, None, None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    found = got(divergence.audit(df, 4, 3, block, shards))
    assert found == plain(rows, 4, 3)
    assert ("it", "a", "pair", "b", 0, 1) in found and not any(row[0] == "fr" for row in found)


def filled(seeds):
    block = divergence.Block()
    for seed in seeds:
        for lang, source, text in made(60, seed):
            block.add(lang or "", source, text or "")
    return block


def test_a_full_block_spills_segments_in_order_of_term():
    block = filled([2])
    rows = [row for batch in block.run(3, 4) for row in batch.to_pylist()]
    assert {row["run"] for row in rows} == {3} and len({row["shard"] for row in rows}) == len(rows) <= 4
    assert all((found := row["terms"].split(b" ")) == sorted(set(found)) for row in rows)
    assert sum(len(row["counts"]) // 8 for row in rows) == block.size


@pytest.mark.parametrize("size", [1, 3, 8192])
def test_merging_adds_equal_terms_of_runs(size):
    whole, ids, runs = filled(range(5)), {}, []
    for seed in range(5):
        runs += [divergence.Run(row, ids) for batch in filled([seed]).run(seed, 1) for row in batch.to_pylist()]
    found, names = {}, list(ids)
    last = b""
    for terms, groups, counts, docs in divergence.merged(runs, size):
        terms = terms.to_pylist()
        assert terms == sorted(terms) and (not found or terms[0] > last)
        last = terms[-1]
        found |= {(*names[g], t): (c, d) for t, g, c, d in zip(terms, groups, counts.tolist(), docs.tolist(), strict=True)}
    expected = {(*key, t): (c[t], d[t] + 1) for key, (c, d) in whole.groups.items() for t in c}
    assert found.keys() == expected.keys() and all(found[key] == expected[key] for key in found if key[2])


def test_given_documents_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert got(queries.op11_divergence(spark, folder)) == set(sql.sql(divergence.ORACLE_SQL).fetchall())


def test_odd_rows_and_empty_tables(spark):
    schema = "lang string, source string, text string, term string, p int, count int, run int, shard int"
    more = ("t", 1, 2, 3, 4)
    rows = [("en", "a", "x " * 100_000, *more), ("en", "b", "x y", *more), ("en", "b", "x y", *more), (None, None, "x y", *more)]
    df = spark.createDataFrame(rows, schema)
    assert got(divergence.audit(df, 2, 10)) == plain([r[:3] for r in rows], 2, 10)
    assert divergence.audit(df.limit(0)).collect() == []
