"""Which syncs are due, asked of the run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from shelfsync.operators.detect import ts_literal


def last_runs(runs: DataFrame) -> DataFrame:
    """``workspace_id, last_full, last_quick`` of a run log.  A forced run
    processes what a full one would, so it counts as full."""
    each = runs.select("as_of", F.explode("tenants").alias("t")).select("as_of", "t.workspace_id", "t.mode")
    full = F.col("mode").isin("full", "force")
    return each.groupBy("workspace_id").agg(F.max(F.when(full, F.col("as_of"))).alias("last_full"),
                                            F.max(F.when(F.col("mode") == "quick", F.col("as_of"))).alias("last_quick"))


def due_syncs(runs: DataFrame, schedule: DataFrame, now: dt.datetime) -> DataFrame:
    """``workspace_id, mode, last_full, last_quick``: the sync each workspace is
    due for at ``now``, or NULL.

    ``schedule`` has ``workspace_id, quick_minutes, full_minutes``; 0 disables a
    kind.  A workspace that never had a full run is due for one, whatever its
    settings; a due full run wins over a due quick one; the quick clock starts
    at the last quick run, or else at the last full one.
    """
    s = schedule.join(last_runs(runs), "workspace_id", "left")
    at = ts_literal(now)

    def elapsed(since, minutes):
        return (F.col(minutes) > 0) & (F.timestamp_diff("SECOND", since, at) >= F.col(minutes) * 60)

    mode = (F.when(F.col("last_full").isNull(), "full").when(elapsed(F.col("last_full"), "full_minutes"), "full")
            .when(elapsed(F.coalesce("last_quick", "last_full"), "quick_minutes"), "quick"))
    return s.select("workspace_id", mode.alias("mode"), "last_full", "last_quick")
