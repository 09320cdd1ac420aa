"""Due syncs from the run log, and the periodic turn that runs them."""

import datetime as dt

from shelfsync.config import ColumnMapping, SyncConfig
from shelfsync.operators.embed import hashing_embedder
from shelfsync.operators.schedule import due_syncs
from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_due
from shelfsync.schema import RUNS
from shelfsync.sources.store import TableStore
from shelfsync.streaming.stream import choose_mode

T0 = dt.datetime(2024, 1, 1)
M = dt.timedelta(minutes=1)
WS = ["00000000-0000-0000-0000-00000000000a", "00000000-0000-0000-0000-00000000000b"]
EMB = FunctionEmbedder(hashing_embedder(8), 50)


def log(spark, rows):
    names = [f.name for f in RUNS.fields]
    return spark.createDataFrame([tuple({"as_of": at, "tenants": [{"workspace_id": w, "mode": m} for w, m in of]}.get(n)
                                        for n in names) for at, of in rows], RUNS)


def test_due_syncs_follow_the_rule_of_choose_mode(spark):
    cases = []
    for full in (None, 0, 30, 2000):
        for quick in (None, 5, 15, 3000):
            for qm, fm in ((15, 1440), (0, 1440), (15, 0), (0, 0)):
                cases.append((full, quick, qm, fm))
    runs, plan, expect = [], [], {}
    for i, (full, quick, qm, fm) in enumerate(cases):
        ws = f"w{i}"
        last = [None if m is None else T0 - m * M for m in (full, quick)]
        runs += [(at, [(ws, mode)]) for at, mode in zip(last, ("full", "quick"), strict=True) if at is not None]
        runs += [(at - M, [(ws, mode), ("other", "full")]) for at, mode in zip(last, ("force", "quick"), strict=True) if at is not None]
        plan.append((ws, qm, fm))
        expect[ws] = choose_mode(T0, *last, qm, fm)
    got = due_syncs(log(spark, runs), spark.createDataFrame(plan, "workspace_id string, quick_minutes int, full_minutes int"), T0)
    assert {r.workspace_id: r.mode for r in got.collect()} == expect


def test_periodic_turns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 2)
    src = spark.createDataFrame([(1, "a", "1", 1.0)], "id long, descricao string, codigo string, preco double")
    tenants = [Tenant(src, SyncConfig(w, ColumnMapping())) for w in WS]

    def turn(some, minutes):
        r = run_due(spark, store, some, T0 + minutes * M, embedder=EMB)
        return r and (r["modes"], r["workspaces"])

    assert turn(tenants[:1], 0) == ("full", WS[0])              # never ran
    assert turn(tenants, 10) == ("full", WS[1])                 # the other is not due yet
    assert turn(tenants, 12) is None
    assert turn(tenants, 26) == ("quick", ",".join(WS))
    assert turn(tenants, 30) is None
    assert turn(tenants, 1441) == ("full,quick", ",".join(WS))  # a full one is due for the first only
    assert store.read("runs").count() == 4
