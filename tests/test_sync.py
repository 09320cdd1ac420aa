"""Properties of whole runs."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from shelfsync.config import SyncConfig
from shelfsync.operators.embed import hashing_embedder
from shelfsync.plans import fixtures as fx
from shelfsync.plans.sync import FunctionEmbedder, TableEmbedder, Tenant, run_sync
from shelfsync.sources.store import TableStore

from conftest import SF001

T1 = dt.datetime(2024, 1, 1)


def tenants(spark, mode):
    return [Tenant(fx.part_source(spark, SF001), SyncConfig(fx.WS_PART, fx.PART_MAPPING, mode=mode)),
            Tenant(fx.table(spark, SF001, "supplier"), SyncConfig(fx.WS_SUPPLIER, fx.SUPPLIER_MAPPING, mode=mode))]


def snapshot(store):
    t = sorted(tuple(r) for r in store.read("target").collect())
    v = sorted((r.workspace_id, r.id, tuple(r.embedding)) for r in store.read("vectors").collect())
    s = sorted(tuple(r) for r in store.read("state").collect())
    return t, v, s


def test_second_full_run_processes_nothing(spark, store_root):
    store = TableStore(spark, store_root, 4)
    emb = FunctionEmbedder(hashing_embedder(16), 7)
    r1 = run_sync(spark, store, tenants(spark, "full"), embedder=emb, as_of=T1)
    assert r1["to_process"] + r1["skipped"] == r1["total"]
    assert r1["with_embedding"] == r1["n_new"] == r1["total"]
    r2 = run_sync(spark, store, tenants(spark, "full"), embedder=emb, as_of=T1 + dt.timedelta(hours=5))
    assert r2["to_process"] == 0 and r2["skipped"] == r2["total"]
    # quick an hour later refreshes everything stale, as data-only updates,
    # which leave every vector as it was
    before = sorted((r.id, tuple(r.embedding)) for r in store.read_products().collect())
    r3 = run_sync(spark, store, tenants(spark, "quick"), embedder=emb, as_of=T1 + dt.timedelta(hours=6))
    assert r3["to_process"] == r3["total"] and r3["data_only"] == r3["total"]
    assert sorted((r.id, tuple(r.embedding)) for r in store.read_products().collect()) == before
    assert "merge_vectors" not in r3["phases"]
    target = store.read("target")
    assert target.count() == target.select("workspace_id", "id").distinct().count() == r1["total"]
    assert store.read("runs").count() == 3


def test_failed_embeddings_leave_tables_untouched(spark, store_root):
    store = TableStore(spark, store_root, 4)
    part_only = [Tenant(fx.part_source(spark, "/root/testdata/sf0.01"), SyncConfig(fx.WS_PART, fx.PART_MAPPING))]
    vectors = fx.table(spark, SF001, "embeddings")   # covers ids below its row count only
    r = run_sync(spark, store, part_only, embedder=TableEmbedder(vectors, "id", "vec_id"), as_of=T1)
    ids = vectors.select(F.col("vec_id").cast("string").alias("id"))
    n_vec = fx.part_source(spark, "/root/testdata/sf0.01").select(F.col("p_partkey").cast("string").alias("id")).join(ids, "id").count()
    assert r["with_embedding"] == n_vec and r["embed_failed"] == r["total"] - n_vec
    assert store.read("target").count() == n_vec and store.read("state").count() == n_vec


def test_result_independent_of_batch_size_buckets_and_commit_path(spark, tmp_path):
    outs = []
    for i, (batch, buckets, staged) in enumerate([(1, 2, False), (50, 16, True)]):
        store = TableStore(spark, str(tmp_path / f"s{i}"), buckets, staged_commit=staged)
        run_sync(spark, store, tenants(spark, "full"), embedder=FunctionEmbedder(hashing_embedder(16), batch), as_of=T1)
        t = sorted((r.workspace_id, r.id, r.description, tuple(r.embedding)) for r in store.read_products().collect())
        outs.append(t)
    assert outs[0] == outs[1]


def test_embedder_failure_is_per_batch(spark, store_root):
    calls = {"n": 0}

    def flaky(texts):
        if any("red" in t.lower() for t in texts):
            raise RuntimeError("service down")
        return hashing_embedder(8)(texts)

    store = TableStore(spark, store_root, 4)
    r = run_sync(spark, store, tenants(spark, "full")[:1], embedder=FunctionEmbedder(flaky, 1), as_of=T1)
    assert 0 < r["embed_failed"] < r["total"]
    assert r["with_embedding"] + r["embed_failed"] == r["total"]
    assert store.read("target").filter(F.lower("description").contains("red")).count() == 0
    del calls


def test_replay_after_crash_before_state(spark, tmp_path):
    """Lost between two tables of a commit: nothing of it is visible, and the rerun gives the same tables."""
    emb = FunctionEmbedder(hashing_embedder(16), 10)
    clean = TableStore(spark, str(tmp_path / "clean"), 4)
    run_sync(spark, clean, tenants(spark, "full"), embedder=emb, as_of=T1)

    crashed = TableStore(spark, str(tmp_path / "crashed"), 4)
    real = crashed.replace_partitions

    def crash_on_state(name, df, **kw):
        if name == "state":
            raise RuntimeError("executor lost during commit")
        return real(name, df, **kw)

    crashed.replace_partitions = crash_on_state
    with pytest.raises(RuntimeError, match="executor lost"):
        run_sync(spark, crashed, tenants(spark, "full"), embedder=emb, as_of=T1)
    crashed.replace_partitions = real
    assert crashed.read("state").count() == crashed.read("target").count() == 0 and crashed.versions() == []
    run_sync(spark, crashed, tenants(spark, "full"), embedder=emb, as_of=T1)
    assert snapshot(crashed) == snapshot(clean)


def test_orphan_updates_counted_or_repaired(spark, tmp_path):
    """A changed row missing from the target updates nothing and its state
    advances; with repair_orphans it is embedded and inserted instead."""
    emb = FunctionEmbedder(hashing_embedder(8), 10)
    src = fx.table(spark, SF001, "supplier")
    for repair in (False, True):
        cfg = SyncConfig(fx.WS_SUPPLIER, fx.SUPPLIER_MAPPING, mode="quick", repair_orphans=repair)
        first = TableStore(spark, str(tmp_path / f"a{repair}"), 4)
        run_sync(spark, first, [Tenant(src, cfg)], embedder=emb, as_of=T1)
        # a second store whose target lost the odd ids (state intact)
        store = TableStore(spark, str(tmp_path / f"b{repair}"), 4)
        store.replace_partitions("state", first.read("state"))
        store.replace_partitions("target", first.read("target").filter(F.col("id").cast("int") % 2 == 0))
        lost = src.count() - store.read("target").count()
        assert lost > 0
        r = run_sync(spark, store, [Tenant(src, cfg)], embedder=emb, as_of=T1 + dt.timedelta(hours=2))
        if repair:
            assert r["orphans"] == 0 and r["with_embedding"] == lost
            assert store.read("target").count() == src.count()
        else:
            assert r["orphans"] == lost and store.read("target").count() == src.count() - lost


def test_one_file_set_per_partition(spark, tmp_path):
    """Merged rows are rebalanced by partition before the write, so a
    partition directory is not sprayed with one file per shuffle task."""
    import os

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = TableStore(spark, str(tmp_path / "files"), 4)
        run_sync(spark, store, tenants(spark, "full"), embedder=FunctionEmbedder(hashing_embedder(16), 10), as_of=T1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("target", "state", "vectors"):
        root = store.path(name).replace("file:", "")
        for d, _, files in os.walk(root):
            if os.path.basename(d).startswith("bucket="):
                assert len([f for f in files if f.endswith(".parquet")]) == 1, (name, d, files)
