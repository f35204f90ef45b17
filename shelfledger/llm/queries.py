"""The operators as registered queries, each over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfledger.llm import conversations, divergence, html_text, itq, line_dedup, mixing, ngram_join, packing, pieces, pii, quality, topk, warc
from shelfledger.llm.common import Stage, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Stage(spark).folder("archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    read = warc.read_archives(spark, folder, with_payload=False)
    ids = [F.col(name).cast("long").alias(name) for name in ("page_id", "refers_to")]
    return read.select(ids[0], "payload_bytes", "payload_digest", "record_type", ids[1], "url", "complete")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, with_ids=False)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carried=["doc_id"])
    return mixed.withColumnsRenamed({name: name[2:] for name in mixed.columns if name.startswith("m_")})


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed_lines")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carried=["doc_id"])


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), size=4, numerator=85, denominator=100)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.damaged(table(spark, sf_dir, "conversations")), "copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_topk": op3_topk,
    "op4_html": op4_html,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_quality": op8_quality,
    "op9_ngram_join": op9_ngram_join,
    "op10_pii": op10_pii,
    "op11_divergence": op11_divergence,
    "op12_pieces": op12_pieces,
    "op13_conversations": op13_conversations,
}
ORACLES: dict[str, str] = {
    "op3_topk": topk.ORACLE_SQL,
    "op6_line_dedup": line_dedup.ORACLE_SQL,
    "op11_divergence": divergence.ORACLE_SQL,
}
