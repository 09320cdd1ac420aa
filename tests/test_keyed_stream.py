"""Stream state by key: equal to the batch sync, stale rows by timer, restarts."""

import datetime as dt
import time

from pyspark.sql import functions as F

from shelfsync.config import ColumnMapping, SyncConfig
from shelfsync.operators.embed import hashing_embedder
from shelfsync.plans import fixtures as fx
from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_sync
from shelfsync.sources.store import TableStore
from shelfsync.streaming.keyed import keyed_changes, latest_changes, newest_of_batches, write_changes
from shelfsync.streaming.stream import snapshot_stream, write_snapshots

from conftest import SF001

CFG = SyncConfig(fx.WS_EVENTS, fx.EVENTS_MAPPING, mode="full", order_by="ts")
SCHEMA = "sku bigint, name string, price double, at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)


def config(mode, **kw):
    return SyncConfig("w", ColumnMapping(id="sku", description="name", code="at", price="price"), mode=mode, **kw)


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")


def run(spark, path, cfg):
    source = snapshot_stream(spark, f"{path}/in", spark.createDataFrame([], SCHEMA).schema)
    q = write_changes(keyed_changes(source, cfg), f"{path}/out", f"{path}/cp")
    assert q.awaitTermination(120)
    return spark.read.parquet(f"{path}/out")


def test_equals_the_batch_sync(spark, tmp_path):
    events = fx.table(spark, SF001, "events")
    write_snapshots(events, f"{tmp_path}/in", 3)
    q = write_changes(keyed_changes(snapshot_stream(spark, f"{tmp_path}/in", events.schema), CFG),
                      f"{tmp_path}/out", f"{tmp_path}/cp")
    assert q.awaitTermination(120)
    got = latest_changes(spark.read.parquet(f"{tmp_path}/out")).select("id", "fingerprint", "source_order")
    store = TableStore(spark, f"{tmp_path}/b", 8)
    run_sync(spark, store, [Tenant(events, CFG)], embedder=FunctionEmbedder(hashing_embedder(8), 50))
    want = store.read("state").select("id", "fingerprint", "source_order")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 10


def test_state_survives_a_restart(spark, tmp_path):
    path, cfg = str(tmp_path), config("full")
    put(spark, path, [(1, "a", 1.5, T0), (2, "", None, None), (None, "no id", 1.0, T0), (1, "a", 1.5, T0)])
    first = run(spark, path, cfg)
    assert sorted((r.id, r.status, r._r_description, r._r_price, r._r_code) for r in first.collect()) == \
        [("1", "new", "a", 1.5, T0), ("2", "new", "", None, None)]   # microseconds, nulls and empty texts come back
    put(spark, path, [(1, "a", 1.5, T0), (2, "b", 0.1 + 0.2, T0)])
    second = run(spark, path, cfg).filter(F.col("status") == "changed")
    assert [(r.id, r.reason, r._r_price) for r in second.collect()] == [("2", "hash", 0.1 + 0.2)]


def test_older_snapshots_are_skipped_and_a_newer_order_is_remembered(spark, tmp_path):
    path, h = str(tmp_path), dt.timedelta(hours=1)
    cfg = SyncConfig("w", ColumnMapping(id="sku", description="name", code="name", price="price"), mode="full", order_by="at")
    for rows in ([(1, "x", 1.0, T0)], [(1, "x", 1.0, T0 + 2 * h)], [(1, "y", 1.0, T0 + h)], [(1, "z", 1.0, None)]):
        put(spark, path, rows)
        out = run(spark, path, cfg)
    assert [(r._r_description, r.status) for r in out.collect()] == [("x", "new")]
    put(spark, path, [(1, "y", 1.0, T0 + 3 * h)])
    assert latest_changes(run(spark, path, cfg)).first()._r_description == "y"


def test_stale_rows_come_without_new_input(spark, tmp_path):
    path, cfg = str(tmp_path), config("quick", stale_minutes=0.05)   # three seconds
    put(spark, path, [(1, "a", 1.5, T0), (2, "b", 2.5, T0)])
    source = snapshot_stream(spark, f"{path}/in", spark.createDataFrame([], SCHEMA).schema)
    q = write_changes(keyed_changes(source, cfg), f"{path}/out", f"{path}/cp", every="500 milliseconds")
    try:
        end = time.time() + 90
        while time.time() < end:
            time.sleep(1)
            assert q.exception() is None
            if q.lastProgress and len(spark.read.schema("id string").parquet(f"{path}/out").collect()) >= 4:
                break
    finally:
        q.stop()
    rows = spark.read.parquet(f"{path}/out").orderBy("id", "processed_at").collect()
    by_id = {i: [r for r in rows if r.id == i] for i in ("1", "2")}
    for i, name in (("1", "a"), ("2", "b")):
        first, then = by_id[i][:2]
        assert (first.status, first.reason) == ("new", "new") and (then.status, then.reason) == ("changed", "stale")
        assert then._r_description == name and then.fingerprint == first.fingerprint
        assert then.processed_at - first.processed_at >= dt.timedelta(seconds=3)


def test_a_hot_key_sends_one_row_an_arrow_batch(spark):
    rows = (spark.range(30000, numPartitions=1).select(F.lit("w").alias("workspace_id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("fingerprint"), (F.col("id") % 7 != 0).alias("ordered"),
            F.col("id").alias("source_order"), F.lit("{}").alias("payload")))
    out = rows.mapInArrow(newest_of_batches, rows.schema).filter(F.col("id") == "hot").collect()
    assert len(out) == 3 and max(r.source_order for r in out if r.ordered) == 29997
