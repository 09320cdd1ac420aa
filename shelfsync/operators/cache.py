"""Vectors kept by content: one table for all runs and tenants (M2, M5).

A vector's key is the SHA-256 of its text and the model's name, so a text is
embedded once, whoever asks.  The table is append-only Parquet, partitioned by
model and by the key's first two digits; a small batch reads only the parts
its keys fall in.  A row is whole in itself: a lost append leaves some vectors
for the next run to ask for again, and two runs that embed one text at once
leave two equal keys, of which readers take one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsync.operators.embed import EMBED_TEXT, embed_texts, with_embed_text
from shelfsync.session import scratch_path

SCHEMA = "key string, embedding array<float>, model string, part string"


class VectorCache:
    """The vectors of one model under ``path``."""

    def __init__(self, spark: SparkSession, path: str, model: str):
        self.spark, self.path, self.model = spark, path.rstrip("/"), model
        spark.createDataFrame([], SCHEMA).write.mode("ignore").partitionBy("model", "part").parquet(self.path)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """``key, embedding``, one row a key."""
        kept = self.spark.read.schema(SCHEMA).parquet(self.path).filter(F.col("model") == self.model)
        if parts is not None:
            kept = kept.filter(F.col("part").isin(parts))
        # Copies of a key hold the same text's vector: any one does.
        return kept.groupBy("key").agg(F.any_value("embedding").alias("embedding"))

    def add(self, vectors: DataFrame) -> None:
        """Append ``key, embedding`` rows."""
        rows = vectors.select("key", "embedding", F.lit(self.model).alias("model"), F.substring("key", 1, 2).alias("part"))
        rows.hint("rebalance", "part").write.mode("append").partitionBy("model", "part").parquet(self.path)


class CachedEmbedder:
    """An embedder that calls ``fn`` only for texts the cache lacks."""

    def __init__(self, fn: Callable, cache: VectorCache, batch_size: int = 50, concurrency: int | None = None):
        self.fn, self.cache, self.batch_size, self.concurrency = fn, cache, batch_size, concurrency

    def apply(self, rows: DataFrame, configs=()) -> DataFrame:
        """Rows with ``embedding``, ``embed_error`` and ``cached`` (whether the
        vector was there before).  Only new rows are embedded."""
        spark = rows.sparkSession
        rows = rows if EMBED_TEXT in rows.columns else with_embed_text(rows)
        new = rows.filter(F.col("status") == "new").withColumn("key", F.sha2(EMBED_TEXT, 256))
        texts = new.select("key", EMBED_TEXT).distinct()
        parts = [r[0] for r in texts.select(F.substring("key", 1, 2)).distinct().collect()]  # 256 at most
        asked = scratch_path(spark, "embed", "asked")
        kept = self.cache.read(parts)
        texts.join(kept, "key", "left").withColumn("cached", F.col("embedding").isNotNull()).write.parquet(asked)
        asked = spark.read.parquet(asked)
        calls = self.concurrency or spark.sparkContext.defaultParallelism
        answers = scratch_path(spark, "embed", "answers")  # written once: ``fn`` is not called again by a later read
        missing = asked.filter(~F.col("cached"))
        embed_texts(missing, self.fn, self.batch_size, calls).write.parquet(answers)
        answers = spark.read.parquet(answers).withColumn("key", F.sha2(EMBED_TEXT, 256))
        fresh = answers.filter(F.col("embedding").isNotNull()).select("key", "embedding")
        self.cache.add(fresh)
        none = F.lit(None).cast("string")
        vectors = (asked.filter("cached").select("key", "embedding", none.alias("embed_error"), "cached")
                   .unionByName(answers.select("key", "embedding", "embed_error", F.lit(False).alias("cached"))))
        rest = rows.filter(F.col("status") != "new").withColumns({
            "embedding": F.lit(None).cast("array<float>"), "embed_error": none, "cached": F.lit(None).cast("boolean")})
        return new.join(vectors, "key", "left").drop("key").unionByName(rest)
