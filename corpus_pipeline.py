"""The corpus pipeline: five stages over ``documents``, each one of the
training-data operators.  A stage takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsync.llm import linechunks, mixing, neardup, spm, toxicity
from shelfsync.llm.common import WORD, stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs.select(*COLUMNS), model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occur before elsewhere go; every document stays."""
    out = linechunks.dedup_runs(docs, carry=("lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("carry_2"))
    return out.select("doc_id", "text", F.col("carry_0").alias("lang"), F.col("carry_1").alias("source"),
                      n_chars.alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, similarity 0.8)."""
    found = neardup.near_duplicates(docs, width=5, similarity=80)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gid"))
    # Rows sharing a doc_id are one document, but for rows without a word: those link with nothing and stay.
    return docs.select(*COLUMNS).join(gone, (F.col("doc_id") == F.col("gid")) & F.col("text").rlike(WORD), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights."""
    return mixing.emit(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole texts as ids: ``doc_id, n_tokens, ids, round_trip``."""
    return spm.encode(docs, spm.model_bytes())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("mix sources", mix_sources),
    ("sentencepiece", encode),
]

#: The learned filter and the sketches have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
