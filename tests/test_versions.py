"""Commits: all tables of a run at once or none, one writer a version, whole versions for readers."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from shelfsync.config import ColumnMapping, SyncConfig
from shelfsync.operators.embed import hashing_embedder
from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_sync
from shelfsync.sources.files import create_once, names_in, read_text
from shelfsync.sources.store import CommitConflict, TableStore
from shelfsync.streaming.stream import sync_batch

T1 = dt.datetime(2024, 1, 1)
WS = ["00000000-0000-0000-0000-00000000000a", "00000000-0000-0000-0000-00000000000b"]
EMB = FunctionEmbedder(hashing_embedder(8), 50)


def tenant(spark, ws, price, n=40):
    rows = [(i, f"item {i}", str(i), float(price)) for i in range(n)]
    src = spark.createDataFrame(rows, "id long, descricao string, codigo string, preco double")
    return Tenant(src, SyncConfig(ws, ColumnMapping(), mode="full"))


def sync(spark, store, ws, price, **kw):
    return run_sync(spark, store, [tenant(spark, ws, price)], embedder=EMB, as_of=T1, **kw)


def prices(store, version=None):
    return {r.price for r in store.read("target", version).collect()}


def tables(store, version=None):
    return {t: sorted(map(tuple, store.read(t, version).collect())) for t in ("target", "vectors", "state")}


def test_old_versions_stay_readable(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 4)
    assert [sync(spark, store, WS[0], p)["version"] for p in (1, 2)] == [0, 1]
    assert prices(store) == {200.0} and prices(store, 0) == {100.0}
    assert {r.embedding and len(r.embedding) for r in store.read_products(0).collect()} == {8}


@pytest.mark.parametrize("lost", ["vectors", "target", "state"])
def test_failure_inside_a_table_write_leaves_no_trace(spark, tmp_path, lost):
    store = TableStore(spark, str(tmp_path / "s"), 4)
    sync(spark, store, WS[0], 1)
    before = tables(store)
    real = store.replace_partitions

    def breaks(name, df, **kw):
        if name == lost:  # some tasks write their files, then one fails
            df = df.withColumn("bucket", F.when(F.col("id") == "7", F.raise_error(F.lit("disk gone")).cast("int")).otherwise(F.col("bucket")))
        return real(name, df, **kw)

    store.replace_partitions = breaks
    with pytest.raises(Exception, match="disk gone"):
        run_sync(spark, store, [tenant(spark, WS[0], 2, 60)], embedder=EMB, as_of=T1)
    store.replace_partitions = real
    assert tables(store) == before and store.versions() == [0]
    r = run_sync(spark, store, [tenant(spark, WS[0], 2, 60)], embedder=EMB, as_of=T1)
    assert (r["version"], r["n_new"], r["n_changed"]) == (1, 20, 40) and prices(store) == {200.0}


def test_reader_during_a_write_keeps_its_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 4)
    sync(spark, store, WS[0], 1)
    reading = store.read("target")      # planned now, read after two more commits
    sync(spark, store, WS[0], 2)
    sync(spark, store, WS[0], 3)
    assert {r.price for r in reading.collect()} == {100.0} and prices(store) == {300.0}


def test_second_run_on_a_workspace_is_refused(spark, tmp_path):
    one, two = (TableStore(spark, str(tmp_path / "s"), 4) for _ in range(2))
    sync(spark, one, WS[0], 1)
    began = two.snapshot()
    sync(spark, one, WS[0], 2)
    with pytest.raises(CommitConflict):
        sync(spark, two, WS[0], 3, snapshot=began)
    assert prices(two) == {200.0} and two.versions() == [0, 1]
    assert sync(spark, two, WS[0], 3)["version"] == 2


def test_runs_on_other_workspaces_both_commit(spark, tmp_path):
    one, two = (TableStore(spark, str(tmp_path / "s"), 4) for _ in range(2))
    began = two.snapshot()
    sync(spark, one, WS[0], 1)
    assert sync(spark, two, WS[1], 2, snapshot=began)["version"] == 1
    for store in (one, two):
        assert {(r.workspace_id, r.price) for r in store.read("target").collect()} == {(WS[0], 100.0), (WS[1], 200.0)}
        assert store.read("state").count() == 80


def test_batch_lost_after_its_commit_replays_as_nothing(spark, tmp_path):
    """The commit is the replay check: the driver dies right after it, before anything else is noted."""
    store = TableStore(spark, str(tmp_path / "s"), 4)
    cfg = tenant(spark, WS[0], 1).config
    real = store.begin

    def dies_after_publish(snapshot=None):
        commit = real(snapshot)
        publish = commit.publish
        commit.publish = lambda *a: (publish(*a), (_ for _ in ()).throw(RuntimeError("driver lost")))[0]
        return commit

    store.begin = dies_after_publish
    with pytest.raises(RuntimeError, match="driver lost"):
        sync_batch(store, cfg, "s", embedder=EMB)(tenant(spark, WS[0], 1).source, 0)
    again = TableStore(spark, store.root, 4)
    before = tables(again)
    sync_batch(again, cfg, "s", embedder=EMB)(tenant(spark, WS[0], 1).source, 0)
    assert again.versions() == [0] and tables(again) == before and again.read("runs").count() == 1
    sync_batch(again, cfg, "s", embedder=EMB)(tenant(spark, WS[0], 2).source, 1)
    assert again.versions() == [0, 1] and prices(again) == {200.0}


def test_same_batch_twice_at_once_is_committed_once(spark, tmp_path):
    one, two = (TableStore(spark, str(tmp_path / "s"), 4) for _ in range(2))
    base = two.snapshot()
    sync(spark, one, WS[0], 1, stream_id="s", batch_id=0)
    with pytest.raises(CommitConflict):
        sync(spark, two, WS[0], 1, stream_id="s", batch_id=0, snapshot=base)
    assert one.versions() == [0]


def test_create_once_has_one_winner(spark, tmp_path):
    path, won = str(tmp_path / "v" / "1.json"), []

    def go(i):
        if create_once(spark, path, f"writer {i}"):
            won.append(i)

    threads = [threading.Thread(target=go, args=(i,)) for i in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and read_text(spark, path) == f"writer {won[0]}"
    assert names_in(spark, str(tmp_path / "v")) == ["1.json"] and names_in(spark, str(tmp_path / "none")) == []


def test_other_file_systems_create_once(spark, tmp_path, monkeypatch):
    """The branch for file systems that only Spark reaches, on the local one through Hadoop's interface."""
    from shelfsync.sources import files

    monkeypatch.setattr(files, "_local", lambda spark, path: None)
    folder = f"file://{tmp_path}/h"
    assert files.create_once(spark, f"{folder}/a", "é one") and not files.create_once(spark, f"{folder}/a", "two")
    assert files.read_text(spark, f"{folder}/a") == "é one" and files.names_in(spark, folder) == ["a"]
    assert files.names_in(spark, f"{folder}/none") == []


def test_odd_workspace_names_and_many_partitions(spark, tmp_path):
    """Escaped folder names; more partitions than may be named are joined instead of listed."""
    names = ["a b", "c:d=e", "f%41/g", "h{i}*", "plain"]
    rows = spark.range(100).select(F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("id") % 5 + 1).cast("int")).alias("workspace_id"),
                                   F.col("id").cast("string").alias("id"), F.lit("fp").alias("fingerprint"),
                                   F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.lit(None).cast("long").alias("source_order"))
    for most in (1000, 3):
        store = TableStore(spark, str(tmp_path / f"s{most}"), 8, max_static_partitions=most)
        store.replace_partitions("state", store.with_bucket(rows))
        assert {(r.workspace_id, r.id) for r in store.read("state").collect()} == {(r.workspace_id, r.id) for r in rows.collect()}
        some = store.with_bucket(rows.filter(F.col("id") < 6))
        got = {(r.workspace_id, r.id) for r in store.touched("state", some).collect()}
        assert {(r.workspace_id, r.id) for r in some.collect()} <= got and len(got) < 100


def test_stock_beyond_int_is_in_the_run_record(spark, tmp_path):
    rows = [(1, "a", "1", 1.0, "5"), (2, "b", "2", 1.0, "2147483648"), (3, "c", "3", 1.0, "-1e12"), (4, "d", "4", 1.0, "x")]
    src = spark.createDataFrame(rows, "id long, descricao string, codigo string, preco double, estoque string")
    store = TableStore(spark, str(tmp_path / "s"), 2)
    cfg = SyncConfig(WS[0], ColumnMapping(stock="estoque"))
    assert run_sync(spark, store, [Tenant(src, cfg)], embedder=EMB, as_of=T1)["n_stock_lost"] == 2
    assert store.read("runs").first().n_stock_lost == 2
    assert {r.id: r.stock for r in store.read("target").collect()} == {"1": 5, "2": None, "3": None, "4": 0}
    assert os.path.isdir(f"{store.root}/versions")
