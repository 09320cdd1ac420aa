"""Duplicate keys: both forms give the same rows; the second sorts no unique key."""

import datetime as dt
import hashlib
from collections import Counter

import pytest

from shelfsync.config import ColumnMapping, SyncConfig
from shelfsync.operators.dedupe import dedupe_keys, dedupe_repeated
from shelfsync.operators.embed import hashing_embedder
from shelfsync.plans import queries
from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_sync
from shelfsync.sources.store import TableStore

ROWS = ([("w", str(i), f"{i:03d}", i * 1.0) for i in range(50)]
        + [("w", "7", f"z{i % 40}", float(i)) for i in range(400)]          # a key that holds most rows
        + [("v", "7", "a", 1.0), ("v", "7", "a", 1.0), ("v", "8", None, 2.0), ("v", "8", "b", None)]
        + [("w", None, "n", 1.0), ("w", None, "m", 2.0), (None, "1", "q", 3.0)])


def number(x: float) -> str:
    return str(int(x)) if x == int(x) else str(x)


@pytest.mark.parametrize("keys,order", [(["workspace_id", "id"], "fingerprint"), (["id"], ["price", "fingerprint"])])
def test_both_forms_agree(spark, keys, order):
    df = spark.createDataFrame(ROWS, "workspace_id string, id string, fingerprint string, price double").repartition(5)
    one = dedupe_keys(df, keys, order, "n")
    two = dedupe_repeated(df, keys, order, "n").select(*one.columns)
    assert sorted(map(tuple, two.collect()), key=repr) == sorted(map(tuple, one.collect()), key=repr)
    assert dedupe_repeated(df.limit(0), keys, order).count() == 0


def test_unique_keys_are_not_sorted(spark):
    df = spark.createDataFrame(ROWS, "workspace_id string, id string, fingerprint string, price double")
    plan = dedupe_repeated(df, count_col="n")._jdf.queryExecution().sparkPlan().toString()
    before, after = plan.split("SortAggregate", 1) if "SortAggregate" in plan else (plan, "")
    assert "HashAggregate" in plan and "ShuffledHashJoin" in before and "SortMergeJoin" not in plan


def test_rows_are_shuffled_at_full_width_once(spark, tmp_path):
    """Unique and repeated rows are told apart in one shuffle of the rows, null keys or not."""
    schema = "workspace_id string, id string, fingerprint string, price double"
    spark.createDataFrame(ROWS, schema).repartition(3).write.parquet(str(tmp_path / "keyed"))
    out = dedupe_repeated(spark.read.parquet(str(tmp_path / "keyed")), count_col="n")
    rows = out.collect()
    assert sum(r["n"] for r in rows) == len(ROWS) and len(rows) == len({r[:2] for r in ROWS})
    lines = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    moved = [below for line, below in zip(lines, lines[1:]) if "Exchange hash" in line and "Reused" not in line]
    assert len([below for below in moved if "Aggregate" not in below]) == 1, moved


def test_query_shuffles_raw_rows_only(spark, tmp_path):
    """One deal by key for the count and one for the rows; fingerprints are made after it."""
    li = [(o, o % 4 if o % 5 else None, s, 1 + o % 2, float(o % 3), o / 4, "N", "O") for o in range(60) for s in (1, None, o)]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                              "l_extendedprice double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = queries.QUERIES["dedupe_keys"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert {line.split("Exchange ")[1].split("(")[0] + line.split(", ")[-2] for line in plan if "Exchange " in line} == {"hashpartitioningREPARTITION_BY_COL"}
    assert not any("sha2" in line for above, line in zip(plan, plan[1:]) if "Exchange " in above)
    keys = Counter("-".join(str(k) for k in (r[1], r[2]) if k is not None) for r in li)
    got = df.collect()
    assert {r["id"]: r["copies"] for r in got} == keys and len(got) == len(keys)
    for r in got:
        best = max((hashlib.sha256(f"{r['id']}|Line {x[3]} NO|{x[0]}|{number(x[5])}|{number(x[4])}".encode()).hexdigest(), x[5])
                   for x in li if "-".join(str(k) for k in x[1:3] if k is not None) == r["id"])
        assert (r["fingerprint"], r["price_raw"]) == best


def test_staged_sync_reads_the_source_once_and_gives_the_same(spark, tmp_path):
    rows = [(i % 30 if i % 7 else None, f"item {i}", str(i), float(i)) for i in range(120)]
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    src = spark.createDataFrame(rows, "id long, descricao string, codigo string, preco double")
    src = src.mapInPandas(seen, src.schema)
    found = {}
    for dedupe in (True, "staged"):
        store = TableStore(spark, str(tmp_path / str(dedupe)), 4)
        r = run_sync(spark, store, [Tenant(src, SyncConfig("00000000-0000-0000-0000-00000000000a", ColumnMapping()))],
                     embedder=FunctionEmbedder(hashing_embedder(8), 10), as_of=dt.datetime(2024, 1, 1), dedupe=dedupe)
        found[dedupe] = ([r[k] for k in ("total", "n_rejected", "n_duplicates", "to_process")],
                         sorted(map(tuple, store.read("target").select("id", "description", "price").collect())))
        if dedupe == "staged":
            assert reads.value == 2 * len(rows)     # once in either run
    assert found[True] == found["staged"] and found[True][0][0] == 120
