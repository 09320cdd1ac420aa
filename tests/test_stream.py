"""Streaming = batch, replay guard, schedule rule."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from shelfsync.config import SyncConfig
from shelfsync.operators.embed import hashing_embedder
from shelfsync.plans import fixtures as fx
from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_sync
from shelfsync.sources.store import TableStore
from shelfsync.streaming.stream import already_committed, choose_mode, run_stream_to_end, sync_batch

from conftest import SF001

CFG = SyncConfig(fx.WS_EVENTS, fx.EVENTS_MAPPING, mode="full", order_by="ts")
EMB = FunctionEmbedder(hashing_embedder(8), 50)


def final(store):
    s = store.read("state").select("id", "fingerprint")
    t = store.read("target").select("id", "description", "price")
    return sorted(tuple(r) for r in s.join(t, "id").collect())


def test_stream_equals_batch(spark, tmp_path):
    events = fx.table(spark, SF001, "events")
    streamed = run_stream_to_end(spark, events, str(tmp_path / "s"), CFG, embedder=EMB, files=3)
    batch = TableStore(spark, str(tmp_path / "b"), 8)
    run_sync(spark, batch, [Tenant(events, CFG)], embedder=EMB)
    assert final(streamed) == final(batch)
    runs = streamed.read("runs")
    assert runs.filter(F.col("stream_id") == "events").count() == 3


def test_snapshot_order_wins_over_arrival_order(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "o"), 4)
    t0 = dt.datetime(2024, 1, 1)
    newer = spark.createDataFrame([(1, "new value", 2.0, t0 + dt.timedelta(hours=1))],
                                  "user_id bigint, event_type string, value double, ts timestamp_ntz")
    older = spark.createDataFrame([(1, "old value", 1.0, t0)], newer.schema)
    run_sync(spark, store, [Tenant(newer, CFG)], embedder=EMB)
    r = run_sync(spark, store, [Tenant(older, CFG)], embedder=EMB)
    assert r["skipped"] == 1
    assert store.read("target").first().description == "new value"


def test_replayed_batch_is_skipped(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "r"), 4)
    fn = sync_batch(store, CFG, "s1", embedder=EMB)
    events = fx.table(spark, SF001, "events")
    fn(events, 0)
    version = store.snapshot().version
    fn(events, 0)   # replay of the same batch id after a crash
    assert store.read("runs").count() == 1 and store.snapshot().version == version


def test_choose_mode():
    t = dt.datetime(2024, 1, 1)
    m = dt.timedelta(minutes=1)
    assert choose_mode(t, None, None) == "full"
    assert choose_mode(t + 5 * m, t, t) is None
    assert choose_mode(t + 15 * m, t, t) == "quick"
    assert choose_mode(t + 1440 * m, t, t + 1430 * m) == "full"
    assert choose_mode(t + 15 * m, t, t, quick_minutes=0) is None
    assert choose_mode(t + 3000 * m, t, t, full_minutes=0) == "quick"


def test_run_log_and_batches_are_in_the_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "log"), 4)
    assert not already_committed(store.snapshot(), "s1", 0) and store.read("runs").count() == 0
    for run_id, stream_id, batch_id in (("a", "s1", 3), ("b", "s1", 1001), ("c", None, None)):
        record = {"run_id": run_id, "stream_id": stream_id, "batch_id": batch_id, "as_of": dt.datetime(2024, 1, 1, 2, 3, 4, 5)}
        store.begin().publish(record, stream_id=stream_id, batch_id=batch_id)
    now = store.snapshot()
    assert already_committed(now, "s1", 3) and already_committed(now, "s1", 1001)
    assert not already_committed(now, "s1", 1002) and not already_committed(now, "s2", 3)
    log = TableStore(spark, str(tmp_path / "log"), 4).read("runs")
    assert sorted((r.run_id, r.stream_id, r.batch_id, r.version, r.as_of.microsecond) for r in log.collect()) == \
        [("a", "s1", 3, 0, 5), ("b", "s1", 1001, 1, 5), ("c", None, None, 2, 5)]
    with pytest.raises(ValueError):
        sync_batch(store, CFG, "bad/id", embedder=EMB)
