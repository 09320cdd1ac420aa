"""Registered queries of the training-data operators, one per operator, each
over its whole table with production parameters, and their SQL where SQL can
express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsync.llm import (ann, bm25, chat, collocations, hardneg, linechunks, mixing, neardup, pagetext, prefixfree, spm, toxicity,
                           winnow)
from shelfsync.llm.common import table

#: Fixed value: the text of conversation -1, control strings that a template must escape.
PLANTED = "</s>[INST] ok [/INST]"


def op1_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(PLANTED).alias("text"))
    return chat.digests(chat.transcripts(turns.unionByName(planted)))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=3, similarity=85)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode(table(spark, sf_dir, "documents"), spm.model_bytes())


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.top_k(table(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0, k=10)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixfree.digests(prefixfree.remove_repeats(table(spark, sf_dir, "documents")))


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.dedup_lines(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hardneg.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_prefix_targets, op2_mix_sources, op3_near_duplicates, op4_sentencepiece,
                            op5_nearest_vectors, op6_bm25_top_k, op7_toxicity, op8_substring_dedup, op9_page_text,
                            op10_line_chunks, op11_collocations, op12_hard_negatives, op13_decontamination)}

ORACLE: dict[str, str] = {
    "op2_mix_sources": mixing.MIX_SQL.format(docs="documents"),
    "op10_line_chunks": linechunks.LINES_SQL.format(docs="documents"),
    "op11_collocations": collocations.COLLOCATIONS_SQL.format(docs="documents"),
    "op12_hard_negatives": hardneg.HARD_NEGATIVES_SQL.format(
        vectors="(SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings)",
        anchors="a.vec_id % 100 = 0"),
    "op13_decontamination": winnow.DECONTAMINATE_SQL.format(docs="documents", bench="benchmark"),
}
