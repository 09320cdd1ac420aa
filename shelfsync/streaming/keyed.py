"""Change detection with the state kept by the stream itself.

``streaming/stream.py`` runs a whole batch sync for each micro-batch against
the table store.  Here each key's state lives in the stream's state store
instead (``applyInPandasWithState``): a micro-batch touches only the keys that
it brings, no table is read, and a key whose state grows stale is emitted by a
processing-time timer although no new row of it came (D2, mode ``quick``).

Scale: each Arrow batch of a task is cut to the newest snapshot of each key
before the shuffle, so a key that holds a third of all rows sends one row for
every Arrow batch.  A key's state is one narrow row (fingerprint, time, order
and the mapped values as JSON).  The state store of many keys should be on disk
(``spark.sql.streaming.stateStore.providerClass``: the RocksDB provider).

Recovery is the stream checkpoint's: state and offsets of a batch are committed
together, and a file sink drops a batch that it holds already.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfsync.config import SyncConfig
from shelfsync.sources.scan import keyed_source

#: Microseconds kept, so that a timestamp comes back as it was.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_SNAPSHOT = "workspace_id string, id string, fingerprint string, ordered boolean, source_order bigint, payload string"
CHANGES = _SNAPSHOT + ", status string, reason string, processed_at_ms bigint"
STATE = "fingerprint string, ordered boolean, source_order bigint, payload string, updated_at_ms bigint"


def newest_of_batches(batches: Iterator) -> Iterator:
    """Of each Arrow batch the newest row of each key: the greatest (order, fingerprint), no order being the oldest."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        keys = [(c, "ascending") for c in ("id", "ordered", "source_order", "fingerprint")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=keys))
        ids = rows["id"].combine_chunks()
        last = np.ones(len(ids), dtype=bool)
        last[:-1] = pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
        yield from rows.filter(pa.array(last)).to_batches()


def detector(mode: str, stale_ms: int, by_order: bool):
    """The state function of one key: the rules of ``operators.detect.classify``."""
    def changes(key, frames, state):
        import pandas as pd

        def emit(row, status, reason):
            state.update((*row, now))
            return pd.DataFrame([(*key, *row, status, reason, now)], columns=[f.split()[0] for f in CHANGES.split(", ")])

        now = state.getCurrentProcessingTimeMs()
        out = None
        if state.hasTimedOut:
            *old, _ = state.get
            out = emit(tuple(old), "changed", "stale")
        else:
            newest = None
            for frame in frames:
                for fp, ordered, order, payload in zip(frame.fingerprint, frame.ordered, frame.source_order, frame.payload):
                    row = (bool(ordered), int(order), fp, payload)
                    newest = row if newest is None or row > newest else newest
            ordered, order, fp, payload = newest
            row = (fp, ordered, order, payload)
            if not state.exists:
                out = emit(row, "new", "new")
            else:
                old_fp, old_ordered, old_order, old_payload, at = state.get
                same, fresh = fp == old_fp, now - at < stale_ms
                older = by_order and old_ordered and (ordered, order, fp) < (old_ordered, old_order, old_fp)
                skip = older or (same and {"quick": fresh, "full": True}.get(mode, False))
                if not skip:
                    out = emit(row, "changed", "hash" if not same else "forced" if fresh else "stale")
                elif same and by_order and (ordered, order) > (old_ordered, old_order):
                    state.update((fp, ordered, order, payload, at))   # a newer order is remembered
        if mode == "quick":
            # Each call clears the timer, so it is set anew, for the rest of the time.
            state.setTimeoutDuration(max(1, state.get[4] + stale_ms - now))
        if out is not None:
            yield out
    return changes


def payload_schema(changes_of: DataFrame) -> T.StructType:
    return T.StructType([f for f in changes_of.schema.fields if f.name.startswith("_r_")])


def keyed_changes(source: DataFrame, config: SyncConfig) -> DataFrame:
    """The rows of a streaming ``source`` that a sync would process.

    Columns as after ``detect.to_process``: ``workspace_id, id, fingerprint``, the raw ``_r_*`` values, ``source_order``,
    ``status`` (new, changed) and ``reason`` (new, hash, stale, forced), and ``processed_at``.  Of a key's rows in one
    micro-batch the newest counts.  Modes follow ``detect.classify``; with ``order_by`` an older snapshot is skipped.  In
    ``quick`` a key is emitted again, with its last values, once it is stale, whether or not it comes again.

    Edge cases: rows with a null id are dropped; a null order is the oldest; an empty stream emits nothing.
    """
    by_order = config.order_by is not None
    keyed = keyed_source(source, config.mapping, config.workspace_id, {"_order": config.order_by} if by_order else None)
    values = payload_schema(keyed)
    order = F.col("_order") if by_order else F.lit(None).cast("bigint")
    rows = keyed.select("workspace_id", "id", "fingerprint", order.isNotNull().alias("ordered"),
                        F.coalesce(order, F.lit(0)).alias("source_order"),
                        F.to_json(F.struct(*values.names), JSON_OPTIONS).alias("payload"))
    stale_ms = int(config.stale_minutes * 60_000)
    out = (rows.mapInArrow(newest_of_batches, _SNAPSHOT).groupBy("workspace_id", "id")
           .applyInPandasWithState(detector(config.mode, stale_ms, by_order), CHANGES, STATE, "append",
                                   "ProcessingTimeTimeout" if config.mode == "quick" else "NoTimeout"))
    return (out.withColumn("_v", F.from_json("payload", values, JSON_OPTIONS))
            .select("workspace_id", "id", "fingerprint", *[F.col(f"_v.{n}").alias(n) for n in values.names],
                    F.when(F.col("ordered"), F.col("source_order")).alias("source_order"), "status", "reason",
                    F.timestamp_millis("processed_at_ms").alias("processed_at")))


def write_changes(changes: DataFrame, path: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Append the changes to Parquet files under ``path``: what has arrived, then end (``every`` None), or at each
    interval for good.  Staleness timers need ``every``: they fire at its ticks."""
    writer = changes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start(path)


def latest_changes(changes: DataFrame) -> DataFrame:
    """The current row of every key among written changes."""
    rest = [c for c in changes.columns if c not in ("workspace_id", "id", "source_order", "processed_at", "fingerprint")]
    newest = F.max(F.struct("source_order", "processed_at", "fingerprint", *rest)).alias("_n")
    return changes.groupBy("workspace_id", "id").agg(newest).select("workspace_id", "id", "_n.*")
