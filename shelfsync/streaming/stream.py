"""Continuous sync over arriving source snapshots.

Each micro-batch is a set of source rows; ``foreachBatch`` runs the batch
sync on it against the same table store, so a stream gives the same tables
as calling the batch sync on each snapshot in order (T2).  The streaming
checkpoint tracks which input was consumed; the batch id is part of the
commit that publishes the batch's rows, so a batch replayed after a crash
finds either all of itself or nothing (T3).  Scheduling is a trigger choice:
``availableNow`` for an external scheduler, ``processingTime`` for a
long-running query (T1).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfsync.config import SyncConfig
from shelfsync.plans.sync import Tenant, run_sync
from shelfsync.sources.store import STREAM_ID_RE, Snapshot, TableStore


def snapshot_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet snapshot files arriving under ``path``, oldest first."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def already_committed(snapshot: Snapshot, stream_id: str, batch_id: int) -> bool:
    """Whether the version holds ``batch_id`` of ``stream_id``.  Batch ids of
    one checkpoint rise one by one, so the last one says it."""
    return snapshot.streams.get(stream_id, -1) >= batch_id


def sync_batch(store: TableStore, config: SyncConfig, stream_id: str, *, titles=None, embedder=None,
               as_of_fn=None):
    """The ``foreachBatch`` function: one batch sync per micro-batch.
    ``stream_id`` names the stream in the versions, so it is a plain token."""
    if not re.match(STREAM_ID_RE, stream_id):
        raise ValueError(f"stream_id must match {STREAM_ID_RE}: {stream_id!r}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snapshot = store.snapshot()
        if already_committed(snapshot, stream_id, batch_id):
            return
        as_of = as_of_fn(batch_id) if as_of_fn else None
        # A micro-batch's parallelism is the stream's own setting (Kafka
        # ``minPartitions``, ``maxFilesPerTrigger``).
        run_sync(spark, store, [Tenant(batch, config)], titles=titles, embedder=embedder, as_of=as_of,
                 batch_id=batch_id, stream_id=stream_id, prune_state=True, snapshot=snapshot)
    return run


def start_sync_stream(source: DataFrame, store: TableStore, config: SyncConfig, checkpoint: str,
                      stream_id: str, *, titles=None, embedder=None, available_now: bool = True,
                      every: str | None = None, as_of_fn=None) -> StreamingQuery:
    """Start the sync as a streaming query (``availableNow`` or every N)."""
    writer = (source.writeStream.foreachBatch(sync_batch(store, config, stream_id, titles=titles,
                                                          embedder=embedder, as_of_fn=as_of_fn))
              .option("checkpointLocation", checkpoint).queryName(f"sync_{stream_id}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every or "15 minutes")
    return writer.start()


def choose_mode(now: dt.datetime, last_full: dt.datetime | None, last_quick: dt.datetime | None,
                quick_minutes: int = 15, full_minutes: int = 1440) -> str | None:
    """Which sync a periodic driver should run now: the first run is full; a
    due full run wins over a due quick one; 0 disables a kind."""
    if last_full is None:
        return "full"
    if full_minutes > 0 and now - last_full >= dt.timedelta(minutes=full_minutes):
        return "full"
    quick_ref = last_quick or last_full
    if quick_minutes > 0 and now - quick_ref >= dt.timedelta(minutes=quick_minutes):
        return "quick"
    return None


def write_snapshots(source: DataFrame, path: str, files: int = 4) -> None:
    """Lay a table out as ``files`` snapshot files for a file-source stream
    (spread by hash, so snapshots of one key arrive in any order)."""
    source.repartition(files).write.mode("append").parquet(path)


def run_stream_to_end(spark: SparkSession, source_df: DataFrame, base: str, config: SyncConfig,
                      stream_id: str = "events", files: int = 4, **kwargs) -> TableStore:
    """Write ``source_df`` as snapshot files under ``base``, stream them
    through the sync with ``availableNow`` and return the store."""
    write_snapshots(source_df, f"{base}/in", files)
    store = TableStore(spark, f"{base}/store", kwargs.pop("num_buckets", 8))
    stream = snapshot_stream(spark, f"{base}/in", source_df.schema)
    q = start_sync_stream(stream, store, config, f"{base}/checkpoint", stream_id, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return store
