"""Run summaries (A1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _n(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def detection_exprs() -> list[Column]:
    """Counts over a classified table; usable in ``agg`` or ``observe``."""
    p = F.col("process")
    new = F.col("status") == "new"
    return [F.count(F.lit(1)).alias("total"),
            _n(p).alias("to_process"),
            _n(~p).alias("skipped"),
            _n(p & new).alias("n_new"),
            _n(p & ~new).alias("n_changed"),
            _n(p & (F.col("reason") == "hash")).alias("n_hash"),
            _n(p & F.col("reason").isin("stale", "forced")).alias("n_stale")]


def run_exprs() -> list[Column]:
    """Counts over classified rows that stand for ``_copies`` source rows
    each, null ids included: total = to_process + skipped + n_rejected (null
    ids) + n_duplicates (further rows of a kept key)."""
    n, kept = F.col("_copies"), F.col("id").isNotNull()
    p = kept & F.col("process")
    new = F.col("status") == "new"

    def total(cond, value):
        return F.sum(F.when(cond, value).otherwise(0)).cast("bigint")

    return [F.sum(n).cast("bigint").alias("total"),
            total(~kept, n).alias("n_rejected"),
            total(kept, n - 1).alias("n_duplicates"),
            _n(p).alias("to_process"),
            _n(kept & ~F.col("process")).alias("skipped"),
            _n(p & new).alias("n_new"),
            _n(p & ~new).alias("n_changed"),
            _n(p & (F.col("reason") == "hash")).alias("n_hash"),
            _n(p & F.col("reason").isin("stale", "forced")).alias("n_stale")]


def detection_summary(classified: DataFrame, by: tuple[str, ...] = ("workspace_id",)) -> DataFrame:
    """Per-workspace counts: total = to_process + skipped."""
    return classified.groupBy(*by).agg(*detection_exprs())


def outcome_exprs() -> list[Column]:
    """Counts over a staged change set (after enrichment and embedding)."""
    a = F.col("action")
    return [_n(F.col("title").isNotNull()).alias("lookups_found"),
            _n(a == "upsert").alias("with_embedding"),
            _n(a == "update").alias("data_only"),
            _n(a == "drop").alias("embed_failed")]


def run_summary(classified: DataFrame, out: DataFrame, target: DataFrame) -> DataFrame:
    """The whole run summary per workspace: detection counts over every
    row, outcome counts over processed rows, orphans against the target."""
    from shelfsync.operators.merge import orphan_updates
    from shelfsync.schema import KEYS

    det = detection_summary(classified)
    outc = out.groupBy("workspace_id").agg(*outcome_exprs())
    orph = orphan_updates(target, out).groupBy("workspace_id").agg(F.count(F.lit(1)).alias("orphans"))
    cols = ["lookups_found", "with_embedding", "data_only", "embed_failed"]
    return (det.join(outc, "workspace_id", "left").join(orph, "workspace_id", "left")
            .select("workspace_id", *[c for c in det.columns if c != "workspace_id"],
                    *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols],
                    F.coalesce(F.col("orphans"), F.lit(0)).cast("bigint").alias("orphans"))
            .withColumn("processed", F.col("to_process")))
