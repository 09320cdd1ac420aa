"""Keyed merges into the target and the state.

Both merges are one full outer join of the (touched part of the) table
with the change set on the key — set-based, no per-row statements.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, functions as F

from shelfsync.operators.detect import ts_literal
from shelfsync.schema import KEYS, UPDATE_COLUMNS


def merge_products(target: DataFrame, changes: DataFrame, extra_keys: tuple[str, ...] = (),
                   orphans: Observation | None = None, with_vectors: bool = True,
                   mark_orphans: bool = False) -> DataFrame:
    """Apply upserts and data-only updates to ``target``.

    * ``upsert`` rows insert, or replace every column including the vector;
    * ``update`` rows replace the ten data columns of an existing row and
      keep its vector; an update whose key is absent writes nothing;
    * a NULL in an update lands as NULL (match flag, not ``coalesce``).
    ``changes`` must hold one row per key (see ``dedupe_keys``).  With an
    ``orphans`` observation, updates that matched nothing are counted in the
    same job that writes the result.  ``with_vectors=False`` merges the
    data columns only (vectors kept in their own table, see
    :func:`merge_vectors`).  ``mark_orphans=True`` keeps the orphan updates
    as rows flagged ``_orphan`` for the caller to count and drop (see
    :func:`drop_orphans`).
    """
    keys = [*KEYS, *extra_keys]
    vec = ["embedding"] if with_vectors else []
    t = target.select(*keys, *UPDATE_COLUMNS, *vec, F.lit(True).alias("_t"))
    c = changes.filter(F.col("action").isin("upsert", "update")).select(
        *keys, *[F.col(x).alias(f"_c_{x}") for x in UPDATE_COLUMNS],
        *[F.col(x).alias(f"_c_{x}") for x in vec], F.col("action").alias("_a"))
    j = t.join(c, keys, "full_outer")
    has_t = F.col("_t").isNotNull()
    upsert = F.col("_a") == "upsert"
    changed = F.col("_a").isNotNull()
    cols = [F.when(changed, F.col(f"_c_{x}")).otherwise(F.col(x)).alias(x) for x in UPDATE_COLUMNS]
    emb = [F.when(upsert, F.col("_c_embedding")).otherwise(F.col("embedding")).alias("embedding")] if vec else []
    if orphans is not None:
        j = j.observe(orphans, F.sum(F.when(~has_t & (F.col("_a") == "update"), 1).otherwise(0))
                      .cast("bigint").alias("orphans"))
    if mark_orphans:
        return j.select(*keys, *cols, *emb, (~has_t & ~F.coalesce(upsert, F.lit(False))).alias("_orphan"))
    return j.filter(has_t | F.coalesce(upsert, F.lit(False))).select(*keys, *cols, *emb)


def drop_orphans(merged: DataFrame, orphans: Observation | None = None) -> DataFrame:
    """Count (when ``orphans`` is given) and drop the rows flagged by
    ``merge_products(..., mark_orphans=True)``."""
    if orphans is not None:
        merged = merged.observe(orphans, F.sum(F.when(F.col("_orphan"), 1).otherwise(0)).cast("bigint").alias("orphans"))
    return merged.filter(~F.col("_orphan")).drop("_orphan")


def merge_vectors(vectors: DataFrame, changes: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Vectors of upserted rows replace or join the vector table; data-only
    updates never touch it."""
    keys = [*KEYS, *extra_keys]
    ups = changes.filter(F.col("action") == "upsert").select(*keys, "embedding")
    return upsert_rows(vectors.select(*keys, "embedding"), ups, keys)


def orphan_updates(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Data-only updates whose key is missing from the target: they write
    nothing, yet their state advances unless repaired."""
    upd = changes.filter(F.col("action") == "update")
    return upd.join(target.select(*KEYS), KEYS, "left_anti")


def written(changes: DataFrame) -> DataFrame:
    """Rows whose state advances: upserts and updates (orphans included), and touches (order only)."""
    return changes.filter(F.col("action").isin("upsert", "update", "touch"))


def merge_state(state: DataFrame, changes: DataFrame, as_of: dt.datetime,
                extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Advance (fingerprint, updated_at = as_of) for written rows only; a
    touch moves the order and keeps ``updated_at``."""
    keys = [*KEYS, *extra_keys]
    has_order = "source_order" in state.columns
    s = state.select(*keys, "fingerprint", "updated_at", *(["source_order"] if has_order else []))
    order = F.col("_order") if "_order" in changes.columns else F.lit(None).cast("bigint")
    w = written(changes).select(*keys, F.col("fingerprint").alias("_w_fp"), order.alias("_w_order"),
                                 (F.col("action") == "touch").alias("_w_touch"))
    j = s.join(w, keys, "full_outer")
    hit = F.col("_w_fp").isNotNull()
    out = [F.when(hit, F.col("_w_fp")).otherwise(F.col("fingerprint")).alias("fingerprint"),
           F.when(hit & ~F.col("_w_touch"), ts_literal(as_of)).otherwise(F.col("updated_at")).alias("updated_at")]
    if has_order:
        out.append(F.when(hit, F.col("_w_order")).otherwise(F.col("source_order")).alias("source_order"))
    return j.select(*keys, *out)


def upsert_rows(table: DataFrame, rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Generic insert-or-replace: rows of ``table`` whose key is not in
    ``rows``, plus ``rows``."""
    return table.join(rows.select(*keys), keys, "left_anti").unionByName(rows)
