from __future__ import annotations

import hashlib
import random

import duckdb
import pytest

from shelfledger.llm import line_dedup
from shelfledger.llm.common import table
from shelfledger.llm.queries import op6_line_dedup


def plain(rows, window=2, divisor=2, min_lines=2, min_words=50):
    """Chunks of each distinct row by a loop over its lines; then the first of equal units in order stays."""
    split = {}
    for doc_id, text in rows:
        if text is None or (doc_id, text) in split:
            continue
        parts, hashes, lines = [[]], [], text.split("\n")
        solo = [line.count(" ") + 1 >= line_dedup.SOLO_WORDS for line in lines] + [False]
        for n, line in enumerate(lines):
            parts[-1].append(line)
            hashes.append(int(hashlib.md5(line.encode()).hexdigest()[:7], 16))
            if sum(h * 31**k for k, h in enumerate(hashes[: -window - 1 : -1])) % divisor == 0 or solo[n] or solo[n + 1]:
                parts.append([])
        split[doc_id, text] = [tuple(part) for part in parts if part]
    seen, gone = set(), {}
    for key, parts in sorted(split.items(), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        for n in range(len(parts)):
            for unit in ((parts[n],), tuple(parts[n : n + 2])) if n + 1 < len(parts) else ((parts[n],),):
                lines = [line for part in unit for line in part]
                if len(lines) >= min_lines or sum(line.count(" ") + 1 for line in lines) >= min_words:
                    if unit in seen:
                        gone.setdefault(key, set()).update(range(n, n + len(unit)))
                    seen.add(unit)
    result = {}
    for key, parts in split.items():
        kept = [part for n, part in enumerate(parts) if n not in gone.get(key, ())]
        lines = sum(map(len, parts))
        result[key] = ("\n".join(line for part in kept for line in part), lines, lines - sum(map(len, kept)))
    return [(doc_id, *(result[doc_id, text] if text is not None else (None, 0, 0))) for doc_id, text in rows]


def corpus(seed):
    rng = random.Random(seed)
    passage = [f"passage {n} é" for n in range(12)]
    own = [f"line {n}" for n in range(4000)]
    rows = []
    for doc_id in range(150):
        lines = rng.sample(own, rng.randrange(12))
        if rng.random() < 0.5:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passage[rng.randrange(5) :]
        if rng.random() < 0.2:
            lines.insert(0, " ".join(["long"] * 60))
        rows.append((doc_id, "\n".join(lines)))
    return rows + [(500 + n, text) for n, (_, text) in enumerate(rows[:20])]


@pytest.mark.parametrize(("window", "divisor"), [(2, 2), (3, 4), (1, 1)])
def test_against_a_loop(spark, window, divisor):
    rows = corpus(window)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), window, divisor)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows, window, divisor))


def test_chunks_resist_shifts(spark):
    """The same lines after others: every chunk that ends after the first line of theirs is found again."""
    lines = [f"shared {n}" for n in range(40)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["other", *lines]))]
    (row,) = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_lines=1).where("doc_id = 2").collect()
    assert row.text.startswith("other") and row.n_removed_lines >= 35


def test_rows(spark):
    text = "\n".join(f"l{n}" for n in range(30))
    long = "\n".join(str(n) for n in range(30_000))
    rows = [(1, text, 5), (1, text, 5), (1, "other", 5), (None, text, None), (2, None, 6), (3, "", 7), (4, "", 8), (5, long, 9), (6, long, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed_lines"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain([r[:2] for r in rows]), key=str)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []


def test_extra_columns_stay(spark):
    df = spark.createDataFrame([(1, "a", "x", "y")], "doc_id long, text string, hash string, chunk string")
    assert line_dedup.dedup_lines(df).drop("n_lines", "n_removed_lines").collect() == df.collect()


def planted(spark, n_lines, n_words):
    """Share of a passage's lines that is removed from its later places among foreign lines."""
    rng, removed, total = random.Random(n_lines), 0, 0
    rows, passages = [], []
    for n in range(20):
        passage = [" ".join(f"p{n}w{rng.randrange(10**6)}" for _ in range(n_words)) for _ in range(n_lines)]
        passages.append(passage)
        for copy in range(4):
            foreign = [" ".join(f"f{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 15))) for _ in range(12)]
            at = rng.randrange(13)
            rows.append((4 * n + copy, "\n".join([*foreign[:at], *passage, *foreign[at:]]), len(foreign)))
    df = spark.createDataFrame(rows, "doc_id long, text string, foreign int")
    for row in line_dedup.dedup_lines(df).collect():
        left = row.text.split("\n")
        passage = passages[row.doc_id // 4]
        assert row.n_lines - row.n_removed_lines >= row.foreign and sum(line in passage for line in left) + row.foreign == len(left)
        if row.doc_id % 4:
            removed, total = removed + n_lines - sum(line in passage for line in left), total + n_lines
        else:
            assert row.n_removed_lines == 0
    return removed / total


@pytest.mark.parametrize(("n_lines", "n_words"), [(1, 60), (2, 30), (3, 20), (4, 15), (10, 8), (20, 8)])
def test_passages_go_but_for_their_first_place(spark, n_lines, n_words):
    assert planted(spark, n_lines, n_words) == 1


def test_short_lines_go_but_for_the_edges(spark):
    assert planted(spark, 30, 3) > 0.85


def test_exact_copies_in_given_documents_vanish_whole(spark):
    folder = "/root/testdata/sf0.01"
    before = {r.doc_id: r.text for r in table(spark, folder, "documents").orderBy("doc_id").collect()}
    after = {r.doc_id: r for r in op6_line_dedup(spark, folder).collect()}
    seen, copies = set(), []
    for doc_id, text in before.items():
        if text in seen and text:
            copies.append(after[doc_id])
        seen.add(text)
    assert len(copies) > 50 and sum(r.text == "" for r in copies) >= 0.95 * len(copies)


def test_no_python_in_the_plan(spark):
    rows = line_dedup.keyed(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "doc_id", "text")
    assert "Python" not in line_dedup.chunks(rows)._jdf.queryExecution().executedPlan().toString()


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
        expected = db.execute(line_dedup.ORACLE_SQL).fetchall()
    assert sorted(map(tuple, op6_line_dedup(spark, folder).collect())) == sorted(expected)
    assert sum(r[3] for r in expected) > 0
