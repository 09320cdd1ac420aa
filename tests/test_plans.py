"""Plan shapes that carry the scale design: partial aggregation below the
shuffle, one shuffle of the source per tenant, partition pruning, pushdown."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from shelfsync.config import SyncConfig
from shelfsync.operators.dedupe import dedupe_keys
from shelfsync.plans import fixtures as fx
from shelfsync.plans.sync import Tenant, plan_changes
from shelfsync.sources.scan import keyed_source, spread
from shelfsync.sources.store import TableStore

from conftest import SF001


def plan_of(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_dedupe_is_partial_before_shuffle(spark):
    keyed = keyed_source(fx.lineitem_source(spark, SF001), fx.LINEITEM_MAPPING, fx.WS_LINEITEM)
    plan = plan_of(dedupe_keys(keyed))
    below = plan[plan.index("Exchange"):]
    assert "partial_max" in below, plan


def test_hot_key_collapses_map_side(spark):
    """A key holding a third of the rows leaves the map side as one row per
    map partition, not as a third of the data."""
    n = 30000
    df = spark.range(n).select(F.lit("w").alias("workspace_id"),
                               F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
                               F.sha2(F.col("id").cast("string"), 256).alias("fingerprint")).repartition(6)
    out = dedupe_keys(df, count_col="copies")
    hot = out.filter(F.col("id") == "hot").first()
    assert hot.copies == n // 3
    assert out.count() == n - n // 3 + 1


def test_one_source_shuffle_per_tenant_and_pruned_state(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 4)
    t = Tenant(fx.part_source(spark, SF001), SyncConfig(fx.WS_PART, fx.PART_MAPPING, mode="quick"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        processed, _ = plan_changes([t], store.read("state").drop("bucket"), dt.datetime(2024, 1, 1))
        plan = plan_of(processed, "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange for the source (dedupe + join share it), one for the state
    assert plan.count("Exchange (") == 2, plan
    assert f"EqualTo(workspace_id,{fx.WS_PART})" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_size:int,p_retailprice:double>" in plan


def test_only_touched_partitions_are_listed(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), 8)
    rows = spark.range(200).select(F.when(F.col("id") % 2 == 0, "w1").otherwise("w2").alias("workspace_id"),
                                   F.col("id").cast("string").alias("id"), F.lit("fp").alias("fingerprint"),
                                   F.lit(None).cast("timestamp_ntz").alias("updated_at"),
                                   F.lit(None).cast("bigint").alias("source_order"))
    store.replace_partitions("state", store.with_bucket(rows))
    keys = store.with_bucket(spark.createDataFrame([("w1", "4"), ("w2", "7")], "workspace_id string, id string"))
    touched = store.touched("state", keys)
    assert touched.count() < 200 and touched.filter(F.col("id").isin("4", "7")).count() == 2
    wanted = {f"workspace_id={r.workspace_id}/bucket={r.bucket}" for r in keys.collect()}
    assert {"/".join(f.split("/")[-3:-1]) for f in touched.inputFiles()} == wanted  # no other folder is listed


def test_spread_is_a_setting(spark):
    """A source is dealt out over the tasks asked for, else left alone."""
    one = spark.range(0, 1000, 1, 1)
    assert "Exchange" not in plan_of(spread(one, None))
    spread_one = spread(one, 6)
    assert "RoundRobinPartitioning" in plan_of(spread_one)
    assert spread_one.rdd.getNumPartitions() == 6
    assert sorted(r[0] for r in spread_one.collect()) == list(range(1000))


def test_same_shape_tenants_share_one_shuffle(spark):
    """Tenants whose keyed rows have one shape are one union, one shuffle and
    one state join; the rows equal those of planning each tenant alone."""
    from shelfsync.plans.sync import tenant_changes
    from shelfsync.operators import detect
    from shelfsync.operators.normalize import normalize

    sup = Tenant(fx.table(spark, SF001, "supplier"), SyncConfig(fx.WS_SUPPLIER, fx.SUPPLIER_MAPPING, mode="quick"))
    cus = Tenant(fx.table(spark, SF001, "customer"), SyncConfig(fx.WS_CUSTOMER, fx.CUSTOMER_MAPPING, mode="quick"))
    state = None
    for t in (sup, cus):
        s = fx.prior_state(keyed_source(t.source, t.config.mapping, t.config.workspace_id))
        state = s if state is None else state.unionByName(s)
    as_of = fx.AS_OF
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        processed, obs = plan_changes([sup, cus], state, as_of, observe=True)
        plan = plan_of(processed, "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(obs) == 1
    # each state branch is derived from its source here, so count the
    # exchanges of the group's own source branch: one hash exchange keyed on
    # (workspace_id, id) feeding both deduplication and the join
    assert "hashpartitioning(workspace_id" in plan, plan
    keep = ("workspace_id", "id", "fingerprint", "status", "reason")
    alone = None
    for t in (sup, cus):
        one = normalize(detect.to_process(tenant_changes(t, state, as_of)), as_of, keep=keep)
        alone = one if alone is None else alone.unionByName(one)
    cols = sorted(alone.columns)
    got = processed.select(*cols)
    assert got.count() == alone.count() > 0
    assert got.exceptAll(alone.select(*cols)).count() == 0 and alone.select(*cols).exceptAll(got).count() == 0


def test_group_plan_has_two_exchanges_in_all(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "g"), 4)
    tenants = [Tenant(fx.table(spark, SF001, "supplier"), SyncConfig(fx.WS_SUPPLIER, fx.SUPPLIER_MAPPING)),
               Tenant(fx.table(spark, SF001, "customer"), SyncConfig(fx.WS_CUSTOMER, fx.CUSTOMER_MAPPING))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        processed, _ = plan_changes(tenants, store.read("state").drop("bucket"), dt.datetime(2024, 1, 1))
        plan = plan_of(processed, "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange (") == 2, plan
    line = [x for x in plan.splitlines() if "In(workspace_id" in x][0]
    assert fx.WS_SUPPLIER in line and fx.WS_CUSTOMER in line


def test_touched_partitions_with_subset_one_job(spark, tmp_path):
    rows = spark.createDataFrame([("w1", "1", "upsert"), ("w1", "2", "update"), ("w2", "3", "update")],
                                 "workspace_id string, id string, action string")
    for bound, static in ((100, True), (1, False)):
        store = TableStore(spark, str(tmp_path / f"b{bound}"), 8, max_static_partitions=bound)
        keyed = store.with_bucket(rows)
        every, ups = store.touched_partitions_with(keyed, F.col("action") == "upsert")
        expect = {(r.workspace_id, r.bucket) for r in keyed.collect()}
        expect_up = {(r.workspace_id, r.bucket) for r in keyed.filter("action = 'upsert'").collect()}
        if static:
            assert set(every) == expect and set(ups) == expect_up
        else:
            assert {tuple(r) for r in every.collect()} == expect and {tuple(r) for r in ups.collect()} == expect_up


def test_keyed_columns_built_once_per_shape(spark, monkeypatch):
    import shelfsync.plans.sync as sync

    calls = []
    real = sync.keyed_columns
    monkeypatch.setattr(sync, "keyed_columns", lambda *a, **k: calls.append(1) or real(*a, **k))
    sup = fx.table(spark, SF001, "supplier")
    tenants = [Tenant(sup, SyncConfig(f"00000000-0000-0000-0000-00000000000{i}", fx.SUPPLIER_MAPPING))
               for i in range(1, 6)]
    tenants.append(Tenant(fx.table(spark, SF001, "customer"), SyncConfig(fx.WS_CUSTOMER, fx.CUSTOMER_MAPPING)))
    state = spark.createDataFrame([], "workspace_id string, id string, fingerprint string, "
                                      "updated_at timestamp_ntz, source_order bigint")
    processed, obs = plan_changes(tenants, state, dt.datetime(2024, 1, 1), observe=True)
    assert len(calls) == 2          # one per (mapping, column types)
    assert len(obs) == 1            # one group: the keyed shapes are equal
    assert processed.count() == 5 * sup.count() + fx.table(spark, SF001, "customer").count()


def test_sync_spreads_a_source_when_asked(spark):
    from shelfsync.config import ColumnMapping

    src = spark.range(0, 300_000, 1, 1).selectExpr("id", "concat('item ', id) AS descricao",
                                                   "cast(id AS string) AS codigo", "id * 0.5 AS preco")
    t = Tenant(src, SyncConfig("00000000-0000-0000-0000-0000000000aa", ColumnMapping()))
    state = spark.createDataFrame([], "workspace_id string, id string, fingerprint string, "
                                      "updated_at timestamp_ntz, source_order bigint")
    spread_plan = plan_of(plan_changes([t], state, dt.datetime(2024, 1, 1), spread_sources=8)[0])
    assert "RoundRobinPartitioning" in spread_plan
    stream_plan = plan_of(plan_changes([t], state, dt.datetime(2024, 1, 1))[0])
    assert "RoundRobinPartitioning" not in stream_plan
