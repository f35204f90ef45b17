"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and gives documents with the same columns; the last gives the packed pieces.
Columns of other names than those of documents pass through in a struct, so that none meets a name of an operator.
``run`` writes every stage's result as Parquet under ``spark.checkpoint.dir`` and reads it for the next one, so a lost
executor costs no stage that is done.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfledger.llm import line_dedup, mixing, ngram_join, packing, quality
from shelfledger.llm.common import Stage, fields_of, table, whole_row

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def keeping_columns(step: Step) -> Step:
    """The step on the columns of documents; all others come back as they were."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [name for name in docs.columns if name not in COLUMNS]
        known = [name for name in docs.columns if name in COLUMNS]
        done = step(spark, docs.select(*known, whole_row(others, "other_columns")), sf_dir)
        columns = dict(zip(others, fields_of("other_columns", others), strict=True))
        return done.select(*(columns.get(name, name) for name in docs.columns))

    return run_step


@keeping_columns
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the combined classifier does not reject."""
    return quality.classify(docs, table(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


@keeping_columns
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; documents of which nothing is left go. ``n_chars`` follows."""
    cleaned = line_dedup.dedup_lines(docs).where("n_removed_lines = 0 or n_removed_lines < n_lines")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("n_removed_lines") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", changed)
    return cleaned.select(*docs.columns)


@keeping_columns
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; rows with one id fare alike."""
    classes = ngram_join.ngram_join(docs, size=5, numerator=80, denominator=100)
    gone = classes.where("not doc_id <=> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti").select(*docs.columns)


@keeping_columns
def mixing_to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with tempered shares of sources, languages and topics."""
    return mixing.mix(docs).where("m_sampled").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, VOCABULARY, with_ids=False)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing", mixing_to_target_weights),
    ("best_fit_packing", best_fit_packing),
]
#: No stage but the second can be put in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
