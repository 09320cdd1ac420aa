"""Benchmark: headline queries plus real sync runs at $BENCH_SF_DIR.

Each query is executed in full through Spark's ``noop`` sink (no driver
collect): once untimed on the smallest tables to warm up, then
$BENCH_RUNS times (default 3), of which the median counts.  The sync runs
write a real store with an embedder that covers every row: an initial load
that lacks a tenth of the keys, then a quick run that meets new keys, changed
prices and one stale tenant.  Rates are over written rows.  Prints one JSON
line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["detect_quick", "normalize_part", "coerce_scalars", "sanitize_text", "title_enrich",
            "embed_join", "embed_batched", "sync_end_to_end", "upsert_products", "state_merge",
            "dedupe_keys", "tenant_union", "dq_report", "workspace_check", "stream_sync"]
WARM_DIR = "/root/testdata/sf0.001"


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from pyspark.sql import functions as F

    from shelfsync.config import SyncConfig
    from shelfsync.operators.embed import hashing_embedder
    from shelfsync.operators.enrich import PageTitles, pages_from_html
    from shelfsync.plans import fixtures as fx
    from shelfsync.plans import queries as q
    from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_sync
    from shelfsync.session import get_spark, scratch_path, work_dir
    from shelfsync.sources.store import TableStore

    spark = get_spark("shelfsync-bench", cpus=cpus)
    work_dir(spark)

    def execute(name: str, folder: str) -> float:
        t0 = time.time()
        q.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.time() - t0

    times = {}
    for name in HEADLINE:
        execute(name, WARM_DIR)
        times[name] = round(statistics.median(execute(name, sf_dir) for _ in range(runs)), 3)

    titles = PageTitles(pages_from_html(fx.table(spark, sf_dir, "pages")))
    embedder = FunctionEmbedder(hashing_embedder(64))
    t_0 = dt.datetime(2024, 1, 1)

    def tenants(mode: str, later: bool) -> list[Tenant]:
        out = []
        for load, m, ws, _, _ in q.TENANTS:
            src, key = load(spark, sf_dir), F.pmod(F.col(m.id), F.lit(10))
            if later:
                src = src.withColumn(m.price, F.when(key == 0, F.col(m.price) + 1).otherwise(F.col(m.price)))
            else:
                src = src.filter(key != 9)  # the catalogue as it was
            out.append(Tenant(src, SyncConfig(ws, m, mode=mode)))
        return out

    def sync(store, some, minutes: int) -> tuple[float, dict]:
        t0 = time.time()
        r = run_sync(spark, store, some, titles=titles, embedder=embedder, as_of=t_0 + dt.timedelta(minutes=minutes))
        return time.time() - t0, r

    store = TableStore(spark, scratch_path(spark, "bench-store"), num_buckets=8)
    old, *rest = tenants("full", False)
    (s1, r1), (s2, r2) = sync(store, [old], 0), sync(store, rest, 60)
    initial = r1["with_embedding"] + r2["with_embedding"]
    s3, r3 = sync(store, tenants("quick", True), 90)
    written = r3["with_embedding"] + r3["data_only"] - r3["orphans"]
    times["sync_run_initial"], times["sync_run_incremental"] = round(s1 + s2, 3), round(s3, 3)

    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": int(cpus), "runs": runs,
                      "sync_rows_written": initial, "sync_target_rows": store.read("target").count(),
                      "sync_rows_per_sec": round(initial / (s1 + s2), 1),
                      "incremental": {k: r3[k] for k in ("total", "skipped", "n_new", "n_hash", "n_stale", "orphans")},
                      "incremental_written": written, "incremental_rows_per_sec": round(written / s3, 1),
                      "sync_phases": {"initial": [r1["phases"], r2["phases"]], "incremental": r3["phases"]}}))


if __name__ == "__main__":
    main()
