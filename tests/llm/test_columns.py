"""Columns of any name beside those that an operator reads: unchanged where rows are returned whole, without effect elsewhere."""

from __future__ import annotations

import ast
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfledger.llm import (
    conversations,
    divergence,
    html_text,
    itq,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pieces,
    pii,
    quality,
    queries,
    topk,
    warc,
)
from shelfledger.llm.common import Stage

FOLDER = Path(warc.__file__).parent
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def own_names(taken: tuple[str, ...]) -> list[str]:
    """Every name that the operators use for a column, and the like: all their literals that could be one."""
    found = set()
    for path in [*FOLDER.glob("*.py"), Path(corpus_pipeline.__file__)]:
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Constant) and isinstance(node.value, str):
                found |= set(re.findall(r"(?<![\w.])[a-z_][a-z_0-9]{0,30}(?![\w(])", node.value)) if len(node.value) < 200 else set()
    return sorted(name for name in found if name not in taken)


def with_extras(df, taken):
    """Extra columns of every such name, in struct fields' and in other kinds' types."""
    names = own_names(taken)
    assert len(names) > 100
    return df.select("*", *[F.lit(n if n % 2 else f"u{n}").alias(name) for n, name in enumerate(names)]), names


TEXTS = [f"line one of {n}\nline two, shared by all\nline three, shared by all\nwords {n} and {n * 7} more" for n in range(10)]


@pytest.fixture(scope="module")
def documents(spark):
    texts = [*TEXTS, TEXTS[3], "", None]
    rows = [(n, text, "en" if n % 2 else "de", f"s{n % 3}", None if text is None else len(text)) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(n, n % 2, 0) for n in range(10)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_of_the_pipeline_keep_them(spark, tmp_path, documents, labels, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs, names = with_extras(documents, DOCUMENTS)
    done = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert done.columns == docs.columns
    rows = done.collect()
    wanted = {tuple(row) for row in docs.select(*names).distinct().collect()}
    assert rows and {tuple(row[name] for name in names) for row in rows} == wanted


def test_operators_that_return_rows_whole(spark, documents, labels):
    for run, added in (
        (lambda df: quality.classify(df, labels), ("text_score", "page_score", "score", "kept")),
        (line_dedup.dedup_lines, ("n_lines", "n_removed_lines")),
        (mixing.mix, mixing.OUTPUTS),
    ):
        docs, names = with_extras(documents, (*DOCUMENTS, *added))
        rows = run(docs).collect()
        wanted = {tuple(row) for row in docs.select(*names).distinct().collect()}
        assert len(rows) == documents.count() and {tuple(row[name] for name in names) for row in rows} == wanted


OTHERS = {
    "packing": (DOCUMENTS, lambda df: packing.pack_documents(df, queries.VOCABULARY, with_ids=False)),
    "ngram_join": (DOCUMENTS, ngram_join.ngram_join),
    "pii": (DOCUMENTS, lambda df: pii.summary(pii.find_personal_data(df))),
    "pieces": (DOCUMENTS, lambda df: pieces.digests(df, queries.PIECE_MODEL)),
    "divergence": (DOCUMENTS, lambda df: divergence.audit(df, min_documents=2)),
}


@pytest.mark.parametrize("name", OTHERS)
def test_operators_on_documents_pass_over_them(documents, name):
    taken, run = OTHERS[name]
    plain = sorted(map(repr, run(documents).collect()))
    assert plain and sorted(map(repr, run(with_extras(documents, taken)[0]).collect())) == plain


def test_operators_on_other_tables_pass_over_them(spark):
    pages = spark.createDataFrame([(n, f"u{n}", f"<article><p>page {n % 3}</p></article>") for n in range(5)], "page_id long, url string, html string")
    vectors = spark.createDataFrame([(n, [float(n % 5), 1.0]) for n in range(60)], "vec_id long, embedding array<double>")
    turns = spark.createDataFrame([(n // 3, n % 3, "user", f"t{n}.") for n in range(12)], "conv_id long, turn long, role string, text string")

    def archived(df):
        folder = Stage(spark).folder("archives")
        warc.write_archives(df, folder)
        return warc.read_archives(spark, folder, with_payload=False)

    for df, taken, run in (
        (pages, ("page_id", "url", "html"), html_text.extract),
        (pages, ("page_id", "url", "html"), archived),
        (vectors, ("vec_id", "embedding"), topk.top_k),
        (vectors, ("vec_id", "embedding"), itq.near_duplicates),
        (turns, ("conv_id", "turn", "role", "text"), conversations.audit),
    ):
        plain = sorted(map(repr, run(df).collect()))
        assert plain and sorted(map(repr, run(with_extras(df, taken)[0]).collect())) == plain
