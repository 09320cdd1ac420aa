"""Change detection against the persisted state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from shelfsync.config import MODES

KEYS = ["workspace_id", "id"]


def ts_literal(value: dt.datetime):
    """A TIMESTAMP_NTZ literal; one per run so replays see the same instant."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def classify(keyed: DataFrame, state: DataFrame, mode: str, as_of: dt.datetime,
             stale_minutes: int = 60, keys: list[str] = KEYS) -> DataFrame:
    """Left-join the keyed source with the state and decide, per row, whether
    it is processed.

    * ``known``  — the key is in the state.
    * ``same``   — the stored fingerprint equals the current one (never NULL).
    * ``fresh``  — stored ``updated_at`` is strictly younger than the stale
      threshold; at exactly the threshold the row is stale.
    * quick skips known & fresh & same; full skips known & same (whatever the
      age, so quick processes a superset of full); force skips nothing.
    * ``status`` is ``new`` when unknown, else ``changed`` — also for a
      stale-but-identical row.  ``reason`` says why a row is processed.

    ``keys`` = ["id"] joins one tenant against a state already filtered to
    its workspace, so a preceding aggregate on ``id`` (deduplication) and
    the join share one shuffle.
    """
    if mode not in MODES:
        raise ValueError(f"unknown sync mode {mode!r}")
    ordered = "_order" in keyed.columns and "source_order" in state.columns
    st = state.select(*keys, F.col("fingerprint").alias("_state_fp"),
                      F.col("updated_at").alias("_state_at"), F.lit(True).alias("_known"),
                      *([F.col("source_order").alias("_state_order")] if ordered else []))
    j = keyed.join(st, keys, "left")
    known = F.coalesce(F.col("_known"), F.lit(False))
    same = F.coalesce(F.col("_state_fp") == F.col("fingerprint"), F.lit(False))
    threshold = ts_literal(as_of - dt.timedelta(minutes=stale_minutes))
    fresh = F.coalesce(F.col("_state_at") > threshold, F.lit(False))
    if mode == "quick":
        skip = known & fresh & same
    elif mode == "full":
        skip = known & same
    else:
        skip = F.lit(False)
    if ordered:
        # A snapshot older than the one applied never overwrites it; snapshots
        # compare by (order, fingerprint), a NULL order being the oldest, so
        # the result does not depend on which batch a snapshot arrives in.
        o, so = F.col("_order"), F.col("_state_order")
        older = so.isNotNull() & (o.isNull() | (o < so) | ((o == so) & (F.col("fingerprint") < F.col("_state_fp"))))
        skip = skip | F.coalesce(older, F.lit(False))
        # An unchanged row of a newer snapshot is skipped, but its order must be
        # remembered, or a snapshot in between could still overwrite it.
        touch = skip & known & same & F.coalesce(so.isNull() | (o > so), F.lit(False)) & o.isNotNull()
    reason = (F.when(~known, "new").when(~same, "hash").when(~fresh, "stale").otherwise("forced"))
    status = F.when(known, F.lit("changed")).otherwise(F.lit("new"))
    if ordered:
        j = j.withColumn("touch", touch)
        status, reason = F.when(F.col("touch"), F.lit("touch")).otherwise(status), F.when(F.col("touch"), F.lit("order")).otherwise(reason)
    return (j.withColumn("process", ~skip)
             .withColumn("status", status)
             .withColumn("reason", reason)
             .drop("_state_fp", "_state_at", "_known", "_state_order"))


def to_process(classified: DataFrame) -> DataFrame:
    """Processed rows, and with snapshot ordering the unchanged rows whose
    newer order only advances the state (status ``touch``)."""
    if "touch" in classified.columns:
        return classified.filter(F.col("process") | F.col("touch"))
    return classified.filter(F.col("process"))


def skipped(classified: DataFrame) -> DataFrame:
    return classified.filter(~F.col("process"))


def new_rows(classified: DataFrame) -> DataFrame:
    """Rows to embed: processed and unknown to the state."""
    return classified.filter(F.col("process") & (F.col("status") == "new"))


def new_rows_anti(keyed: DataFrame, state: DataFrame) -> DataFrame:
    """The same set as :func:`new_rows`, as an anti join: keys the state lacks."""
    return keyed.join(state.select(*KEYS), KEYS, "left_anti")
