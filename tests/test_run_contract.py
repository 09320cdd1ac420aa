"""Run record, embedder and lookup contracts, pruned state, destination sink."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfsync.config import ColumnMapping, SyncConfig
from shelfsync.operators.embed import hashing_embedder
from shelfsync.operators.enrich import ClientTitles, PageTitles
from shelfsync.plans.sync import FunctionEmbedder, TableEmbedder, Tenant, plan_changes, run_sync, source_state
from shelfsync.sources.jdbc import dialect_of, merge_statements
from shelfsync.sources.store import TableStore

T1 = dt.datetime(2024, 1, 1)
WS = [f"00000000-0000-0000-0000-00000000000{i}" for i in range(3)]
SRC = "id long, descricao string, codigo string, preco double"
EMB = FunctionEmbedder(hashing_embedder(8), 10)


def source(spark, rows):
    return spark.createDataFrame(rows, SRC)


def test_record_counts_every_source_row(spark, tmp_path):
    """total = to_process + skipped + rejected (null id) + duplicates."""
    rows = [(1, "a", "1", 1.0), (1, "b", "1", 2.0), (2, "c", "2", 3.0), (None, "d", "3", 4.0), (None, "e", "3", 4.0),
            (3, "f", "4", 5.0)]
    for dedupe in (True, False):
        some = rows if dedupe else rows[1:]
        store = TableStore(spark, str(tmp_path / f"s{dedupe}"), 4)
        tenants = [Tenant(source(spark, some), SyncConfig(WS[0])), Tenant(source(spark, rows[:1]), SyncConfig(WS[1]))]
        r = run_sync(spark, store, tenants, embedder=EMB, as_of=T1, dedupe=dedupe)
        assert (r["total"], r["n_rejected"], r["n_duplicates"], r["to_process"], r["skipped"]) == (
            len(some) + 1, 2, int(dedupe), 4, 0)
        assert store.read("target").count() == 4
        logged = store.read("runs").first()
        assert (logged.total, logged.n_rejected, logged.n_duplicates) == (len(some) + 1, 2, int(dedupe))
    again = run_sync(spark, store, tenants, embedder=EMB, as_of=T1, dedupe=False)
    assert (again["total"], again["skipped"], again["n_rejected"], again["to_process"]) == (6, 4, 2, 0)


def test_embedder_is_required_and_its_width_checked(spark, tmp_path):
    src = source(spark, [(1, "a", "1", 1.0), (2, "b", "2", 2.0)])
    store = TableStore(spark, str(tmp_path / "s"), 4)
    with pytest.raises(ValueError, match="embedder"):
        run_sync(spark, store, [Tenant(src, SyncConfig(WS[0]))], embedder=None)
    tenants = [Tenant(src, SyncConfig(WS[0], embedding_dim=8)), Tenant(src, SyncConfig(WS[1], embedding_dim=1536)),
               Tenant(src, SyncConfig(WS[2]))]
    r = run_sync(spark, store, tenants, embedder=EMB, as_of=T1)
    assert r["with_embedding"] == 4 and r["embed_failed"] == 2
    assert store.read("state").filter(F.col("workspace_id") == WS[1]).count() == 0


def test_batch_size_is_the_tenants_own(spark, tmp_path):
    def width_is_batch(texts):
        return [[float(len(texts))]] * len(texts)

    src = source(spark, [(i, f"item {i}", "c", 1.0) for i in range(12)])
    tenants = [Tenant(src, SyncConfig(WS[0], batch_size=1)), Tenant(src, SyncConfig(WS[1], batch_size=5))]
    store = TableStore(spark, str(tmp_path / "s"), 2)
    run_sync(spark, store, tenants, embedder=FunctionEmbedder(width_is_batch, concurrency=1), as_of=T1)
    most = {r.workspace_id: r.m for r in store.read("vectors").groupBy("workspace_id").agg(
        F.max(F.col("embedding")[0]).alias("m")).collect()}
    assert most == {WS[0]: 1.0, WS[1]: 5.0}


def test_tenants_sharing_ids_have_vectors_of_their_own(spark, tmp_path):
    src = source(spark, [(1, "a", "1", 1.0)])
    vectors = spark.createDataFrame([(WS[0], 1, [1.0]), (WS[1], 1, [2.0])], "ws string, vec_id long, embedding array<double>")
    store = TableStore(spark, str(tmp_path / "s"), 2)
    run_sync(spark, store, [Tenant(src, SyncConfig(w)) for w in WS[:2]], as_of=T1,
             embedder=TableEmbedder(vectors, workspace_col="ws"))
    assert {r.workspace_id: list(r.embedding) for r in store.read("vectors").collect()} == {WS[0]: [1.0], WS[1]: [2.0]}


def test_title_lookup_by_tenant_from_pages_or_client(spark, tmp_path):
    src = source(spark, [(1, "a", "c1", 1.0), (2, "b", "c2", 2.0), (3, "c", "c3", 2.0)])
    pages = spark.createDataFrame([("c1", "Title: One"), ("c2", "Title: Product Not Found"), ("zz", "Title: Other")],
                                  "code string, page string")

    def fetch(code):
        if code == "c3":
            raise RuntimeError("down")
        return {"c1": "Title: One", "c2": "Title: access denied"}[code]

    for name, titles in (("pages", PageTitles(pages)), ("client", ClientTitles(fetch))):
        store = TableStore(spark, str(tmp_path / name), 2)
        tenants = [Tenant(src, SyncConfig(WS[0])), Tenant(src, SyncConfig(WS[1], lookup_enabled=False))]
        r = run_sync(spark, store, tenants, embedder=EMB, titles=titles, as_of=T1)
        assert r["lookups_found"] == 1 and r["with_embedding"] == 6
        shown = {(x.workspace_id, x.id): x.display_name for x in store.read("target").collect()}
        assert shown[WS[0], "1"] == "One" and shown[WS[1], "1"] == "a" and shown[WS[0], "2"] == "b"


def test_state_is_read_by_touched_bucket(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 16)
    big = Tenant(source(spark, [(i, f"item {i}", "c", 1.0) for i in range(200)]), SyncConfig(WS[0]))
    run_sync(spark, store, [big], embedder=EMB, as_of=T1)
    one = Tenant(source(spark, [(7, "item 7", "c", 1.0), (None, "x", "c", 1.0)]), SyncConfig(WS[0]))
    state = source_state(store, [one])
    assert 0 < state.count() < 200
    assert len({f.split("/")[-2] for f in state.inputFiles()}) == 1  # the folder of one bucket
    r = run_sync(spark, store, [one], embedder=EMB, as_of=T1, prune_state=True)
    assert (r["total"], r["skipped"], r["n_rejected"]) == (2, 1, 1)


def test_sink_runs_before_the_state(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 4)
    t = [Tenant(source(spark, [(1, "a", "1", 1.0)]), SyncConfig(WS[0]))]

    def down(live):
        raise RuntimeError("destination down")

    with pytest.raises(RuntimeError, match="destination"):
        run_sync(spark, store, t, embedder=EMB, as_of=T1, sink=down)
    assert store.read("state").count() == 0
    seen = []
    run_sync(spark, store, t, embedder=EMB, as_of=T1, sink=lambda live: seen.extend(r.action for r in live.collect()))
    assert seen == ["upsert"] and store.read("state").count() == 1


def test_statements_per_dialect():
    assert [dialect_of(u) for u in ("jdbc:postgresql://h/d", "jdbc:mysql://h/d", "jdbc:mariadb://h/d", "jdbc:derby:memory:x")] \
        == ["postgresql", "mysql", "mysql", "standard"]
    insert, update = merge_statements("postgresql", "public.products", "stg")
    assert "CAST(s.workspace_id AS uuid)" in insert and "CAST(s.embedding AS vector)" in insert
    assert "ON CONFLICT (id, workspace_id) DO UPDATE SET description = EXCLUDED.description" in insert
    assert insert.endswith("embedding = EXCLUDED.embedding") and "WHERE s.action = 'upsert'" in insert
    assert update.startswith("UPDATE public.products AS t SET description = s.description") and "embedding" not in update
    assert update.endswith("t.workspace_id = CAST(s.workspace_id AS uuid) AND s.action = 'update'")
    insert, update = merge_statements("mysql", "products", "stg")
    assert "ON DUPLICATE KEY UPDATE description = VALUES(description)" in insert and "embedding = VALUES(embedding)" in insert
    assert update.startswith("UPDATE products t JOIN stg s ON t.id = s.id") and "embedding" not in update
    assert len(merge_statements("standard", "p", "s")) == 1
