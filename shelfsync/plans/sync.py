"""The sync chain: scan → fingerprint → dedupe → classify → normalise →
enrich → embed → merge vectors, target and state → one commit.

Everything up to the staged change set is one lazy plan per tenant; tenants
are unioned into one job.  Two materialisations bound the work:

1. the processed rows (detect + normalise), written once, so the costly and
   non-deterministic stages after it never re-scan the source;
2. the outcome (with vectors), written once, so the embedder runs once and
   target and state are merged from the same rows.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shelfsync.config import SyncConfig, as_of_now
from shelfsync.operators import detect, embed, enrich, merge, report, schedule
from shelfsync.operators.dedupe import dedupe_keys, dedupe_repeated
from shelfsync.operators.normalize import normalize, stock_lost
from shelfsync.schema import KEYS, RUNS
from shelfsync.session import scratch_path
from shelfsync.sources.scan import keyed_columns, keyed_source, spread, validate_mapping
from shelfsync.sources.store import Snapshot, TableStore


@dataclass
class Tenant:
    source: DataFrame
    config: SyncConfig


class TableEmbedder:
    """Vectors from a precomputed table keyed like the rows.  Where tenants
    share ids, ``workspace_col`` names the table's column of workspace ids."""

    def __init__(self, vectors: DataFrame, row_key: str = "id", table_key: str = "vec_id",
                 vector_col: str = "embedding", workspace_col: str | None = None):
        self.vectors, self.row_key, self.table_key, self.vector_col = vectors, row_key, table_key, vector_col
        self.workspace_col = workspace_col

    def apply(self, rows: DataFrame, configs: list[SyncConfig] = ()) -> DataFrame:
        return embed.embed_with_table(rows, self.vectors, self.row_key, self.table_key, self.vector_col,
                                      self.workspace_col)


class FunctionEmbedder:
    """Vectors from a batch function called inside ``mapInPandas``, with
    ``batch_size`` texts a call (default: each tenant's own setting)."""

    def __init__(self, fn, batch_size: int | None = None, concurrency: int | None = None):
        self.fn, self.batch_size, self.concurrency = fn, batch_size, concurrency

    def apply(self, rows: DataFrame, configs: list[SyncConfig] = ()) -> DataFrame:
        # Texts are few bytes and calls are slow: left to itself the planner would put them all in one task.
        calls = self.concurrency or rows.sparkSession.sparkContext.defaultParallelism
        by_size: dict[int, list[str]] = {}
        for c in configs:
            by_size.setdefault(self.batch_size or c.batch_size, []).append(c.workspace_id)
        if len(by_size) < 2:
            size = self.batch_size or next(iter(by_size), SyncConfig.batch_size)
            return embed.embed_with_function(rows, self.fn, size, calls)
        return union_all([embed.embed_with_function(rows.filter(F.col("workspace_id").isin(ws)), self.fn, size, calls)
                          for size, ws in sorted(by_size.items())])


def keyed_tenant(tenant: Tenant, built: dict | None = None, keep_null_ids: bool = False) -> DataFrame:
    """One tenant's source through its mapping (a projection, no shuffle).
    ``built`` caches the keyed columns per (mapping, column types) within one
    planning call, so tenants of one shape build their expressions once."""
    cfg = tenant.config
    extra = {"_order": cfg.order_by} if cfg.order_by else None
    if built is None:
        return keyed_source(tenant.source, cfg.mapping, cfg.workspace_id, extra=extra, keep_null_ids=keep_null_ids)
    validate_mapping(tenant.source, cfg.mapping)
    types = {f.name: f.dataType for f in tenant.source.schema.fields}
    used = [*cfg.mapping.source_columns(), *(extra or {}).values()]
    key = (cfg.mapping, tuple((c, types[c].simpleString()) for c in used), tuple((extra or {}).items()))
    if key not in built:
        built[key] = keyed_columns(cfg.mapping, types, extra)
    return keyed_source(tenant.source, cfg.mapping, cfg.workspace_id, extra=extra, columns=built[key],
                        keep_null_ids=keep_null_ids)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """``unionByName`` of many frames, paired off level by level so the
    analysed plans stay shallow (Catalyst flattens the unions anyway)."""
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def _group_key(cfg: SyncConfig, keyed: DataFrame) -> tuple:
    """Tenants whose keyed rows have the same columns and types, and that
    share mode, threshold, rounding and snapshot ordering, are planned as one:
    their normalisation and detection are the same expressions."""
    return (tuple((f.name, f.dataType.simpleString()) for f in keyed.schema.fields),
            cfg.mode, cfg.stale_minutes, cfg.exact_cents, bool(cfg.order_by))


def group_changes(members: list[tuple[Tenant, DataFrame]], state: DataFrame, as_of: dt.datetime,
                  dedupe: bool | str = True, spread_sources: int | None = None, copies: str | None = None) -> DataFrame:
    """Classified rows (lazy, skipped rows included) of tenants planned as one.

    Their keyed sources are unioned, spread if asked for,
    deduplicated and joined with the state on one key, so deduplication and
    the state join share one shuffle for the whole group, however many
    tenants it holds.  The state is read only for the group's workspaces
    (partition pruning on ``workspace_id``).  A group of one tenant keys on
    ``id`` alone, its workspace being a constant.  ``copies`` names a column
    for the number of source rows that each row stands for.  ``dedupe`` is
    True (one pass, every row sorted), False (ids are declared unique) or
    ``"staged"``: the keyed rows are written once to the scratch folder, so
    that any source is read once, and only rows of repeated keys are sorted.
    """
    cfg = members[0][0].config
    workspaces = [t.config.workspace_id for t, _ in members]
    keyed = union_all([k for _, k in members])
    keyed = spread(keyed, spread_sources)
    if len(members) == 1:
        keys = ["id"]
        st = state.filter(F.col("workspace_id") == workspaces[0]).drop("workspace_id")
    else:
        keys = list(KEYS)
        st = state.filter(F.col("workspace_id").isin(workspaces))
    resolve = dedupe_keys
    if dedupe == "staged":
        staged, schema = scratch_path(keyed.sparkSession, "keyed"), keyed.schema
        keyed.write.parquet(staged)
        keyed, resolve = keyed.sparkSession.read.schema(schema).parquet(staged), dedupe_repeated
    if cfg.order_by:
        keyed = resolve(keyed, keys=keys, order_by=["_order", "fingerprint"], count_col=copies)
    elif dedupe:
        keyed = resolve(keyed, keys=keys, count_col=copies)
    elif copies:
        keyed = keyed.withColumn(copies, F.lit(1))
    return detect.classify(keyed, st, cfg.mode, as_of, cfg.stale_minutes, keys=keys)


def tenant_changes(tenant: Tenant, state: DataFrame, as_of: dt.datetime, dedupe: bool | str = True) -> DataFrame:
    """Classified rows of one tenant (lazy), skipped rows included."""
    return group_changes([(tenant, keyed_tenant(tenant))], state, as_of, dedupe)


def plan_changes(tenants: list[Tenant], state: DataFrame, as_of: dt.datetime, dedupe: bool | str = True,
                 observe: bool = False, spread_sources: int | None = None) -> tuple[DataFrame, list[tuple[str, Observation]]]:
    """Processed, normalised rows of all tenants, and (when ``observe``) one
    ``Observation`` of detection counts per group of tenants.

    Tenants with the same source shape and settings form one group (see
    :func:`group_changes`): a thousand tenants of one shop system are one
    union, one shuffle and one state join, not a thousand.  Groups never
    shuffle against each other.  The observations sit between the state
    join and the filter, in the final stage of whatever job consumes the
    result, so skipped rows, null ids and duplicates are counted without a
    second scan, and once each even where a lost task of the scan is repeated.
    """
    workspaces = [t.config.workspace_id for t in tenants]
    if len(set(workspaces)) != len(workspaces):
        raise ValueError("each tenant needs its own workspace_id; union the sources of one workspace first")
    groups: dict[tuple, list[tuple[Tenant, DataFrame]]] = {}
    built: dict = {}
    for t in tenants:
        keyed = keyed_tenant(t, built, keep_null_ids=observe)
        groups.setdefault(_group_key(t.config, keyed), []).append((t, keyed))
    parts, observations = [], []
    for members in groups.values():
        cls = group_changes(members, state, as_of, dedupe, spread_sources, "_copies" if observe else None)
        label = ",".join(t.config.workspace_id for t, _ in members)
        if observe:
            obs = Observation(f"detect_{uuid.uuid4().hex}")
            cls = cls.observe(obs, *report.run_exprs(), stock_lost(cls)).filter(F.col("id").isNotNull())
            observations.append((label, obs))
        keep = ("workspace_id", "id", "fingerprint", "status", "reason", "_order")
        parts.append(normalize(detect.to_process(cls), as_of, members[0][0].config.exact_cents, keep=keep))
    processed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return processed, observations


def outcome(processed: DataFrame, titles, embedder, configs: list[SyncConfig] = ()) -> DataFrame:
    """Enrich new rows, embed new rows, tag each row upsert/update/drop, each
    tenant by its own lookup switch, batch size and vector width."""
    off = [c.workspace_id for c in configs if c.lookup_enabled is False]
    calls = min((c.lookup_concurrency for c in configs if c.lookup_enabled is not False), default=5)
    rows = embed.with_embed_text(enrich.look_up_titles(processed, titles, off, calls))
    rows = embedder.apply(rows, configs)
    rows = embed.check_width(rows, {c.workspace_id: c.embedding_dim for c in configs if c.embedding_dim})
    return embed.with_action(rows)


def repair_orphans(store: TableStore, rows: DataFrame, workspaces: list[str], snapshot: Snapshot | None = None) -> DataFrame:
    """Changed rows of ``workspaces`` whose key is missing from the target
    become ``new`` (reason ``orphan``): they are embedded and upserted
    instead of updating nothing.  Only target partitions touched by changed
    rows are read."""
    b = store.with_bucket(rows)
    changed = b.filter((F.col("status") == "changed") & F.col("workspace_id").isin(workspaces))
    present = store.touched("target", changed, snapshot).select(*KEYS, "bucket", F.lit(True).alias("_in_target"))
    j = b.join(present, [*KEYS, "bucket"], "left")
    orphan = ((F.col("status") == "changed") & F.col("_in_target").isNull()
              & F.col("workspace_id").isin(workspaces))
    return (j.withColumn("status", F.when(orphan, F.lit("new")).otherwise(F.col("status")))
             .withColumn("reason", F.when(orphan, F.lit("orphan")).otherwise(F.col("reason")))
             .drop("_in_target", "bucket"))


def source_state(store: TableStore, tenants: list[Tenant], snapshot: Snapshot | None = None, prune: bool = True) -> DataFrame:
    """The state of the tenants' workspaces; with ``prune``, only in the
    buckets that their source rows fall in."""
    snapshot = snapshot or store.snapshot()
    workspaces = {t.config.workspace_id for t in tenants}
    held = [p for p in snapshot.of("state") if p[0] in workspaces]
    if held and prune:
        keys = union_all([keyed_tenant(t).select(*KEYS) for t in tenants])
        return store.touched("state", store.with_bucket(keys), snapshot)
    return store.read_partitions("state", held, snapshot)


def run_due(spark: SparkSession, store: TableStore, tenants: list[Tenant], now: dt.datetime | None = None, *,
            quick_minutes: int = 15, full_minutes: int = 1440, **options) -> dict | None:
    """One turn of a periodic driver: asks the run log which tenants are due
    for a quick or a full sync and runs them as one sync, each in its mode
    (their own ``config.mode`` is not used).  None where nothing is due."""
    now = now or as_of_now()
    rows = [(t.config.workspace_id, quick_minutes, full_minutes) for t in tenants]
    plan = spark.createDataFrame(rows, "workspace_id string, quick_minutes int, full_minutes int")
    due = {r["workspace_id"]: r["mode"] for r in schedule.due_syncs(store.read("runs"), plan, now).filter("mode IS NOT NULL").collect()}
    some = [Tenant(t.source, replace(t.config, mode=due[t.config.workspace_id])) for t in tenants if t.config.workspace_id in due]
    return run_sync(spark, store, some, as_of=now, **options) if some else None


def in_parallel(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Run Spark jobs that do not depend on each other at the same time; the
    first error is raised when all have ended."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            running.result()


DETECT_KEYS = ("total", "n_stock_lost", "n_rejected", "n_duplicates", "to_process", "skipped", "n_new", "n_changed", "n_hash", "n_stale")
OUTCOME_KEYS = ("lookups_found", "with_embedding", "data_only", "embed_failed")


def run_sync(spark: SparkSession, store: TableStore, tenants: list[Tenant], *,
             embedder, titles=None, sink=None, as_of: dt.datetime | None = None,
             batch_id: int | None = None, stream_id: str | None = None, dedupe: bool | str = True,
             spread_sources: int | None = None, prune_state: bool = False, snapshot: Snapshot | None = None) -> dict:
    """One sync run over ``tenants``; returns the run record (a small dict).

    Jobs: (1) detect + normalise → staged rows, counts observed;
    (2) enrich + embed → staged outcome, counts observed;
    (3) at the same time, into folders of this run's own: vectors of upserts
    merged into touched vector partitions, target partitions merged (data
    columns only), state likewise; (4) one commit that publishes all three
    with the run record and the stream's batch id.  With nothing to write,
    only (1), (2) and (4) run.  The whole run reads one version of the tables
    (``snapshot``, by default the newest); if another run changes one of the
    same workspaces meanwhile, this one raises
    :class:`~shelfsync.sources.store.CommitConflict` and leaves no trace.
    ``spread_sources`` deals narrow sources out over so many tasks (see
    :func:`~shelfsync.sources.scan.spread`).

    ``titles`` is a ``(code, title)`` table or a lookup (see
    :func:`~shelfsync.operators.enrich.look_up_titles`).  ``sink`` is called
    with the staged upserts and updates before the commit
    (e.g. :func:`~shelfsync.sources.jdbc.write_products_jdbc`), so a failing
    destination leaves its rows to the next run; a
    :class:`~shelfsync.sources.jdbc.JdbcSink` also applies a replayed batch once.  ``prune_state`` first asks
    which buckets the source rows fall in (one narrow job) and reads the state
    of those alone: for small batches against a large state.
    """
    started = time.time()
    phases: dict[str, float] = {}

    def mark(name: str, t0: list = [started]) -> None:
        now = time.time()
        phases[name] = round(now - t0[0], 3)
        t0[0] = now

    as_of = as_of or as_of_now()
    run_id = uuid.uuid4().hex
    if embedder is None:
        raise ValueError("a sync needs an embedder")
    configs = [t.config for t in tenants]
    commit = store.begin(snapshot)
    base = commit.base
    state = source_state(store, tenants, base, prune_state).drop("bucket")
    processed, observations = plan_changes(tenants, state, as_of, dedupe, observe=True,
                                           spread_sources=spread_sources)
    stage1 = scratch_path(spark, "runs", run_id, "processed")
    processed.write.parquet(stage1)
    mark("detect")
    detected = dict.fromkeys(DETECT_KEYS, 0)
    for _, obs in observations:
        for k, v in obs.get.items():
            detected[k] += int(v or 0)

    record = {"run_id": run_id, "batch_id": batch_id, "stream_id": stream_id, "as_of": as_of,
              "modes": ",".join(sorted({t.config.mode for t in tenants})),
              "workspaces": ",".join(sorted({t.config.workspace_id for t in tenants})),
              "tenants": [{"workspace_id": t.config.workspace_id, "mode": t.config.mode} for t in tenants],
              **detected, **dict.fromkeys(OUTCOME_KEYS, 0), "orphans": 0}
    workspaces = [t.config.workspace_id for t in tenants]
    ordered = any(t.config.order_by for t in tenants)
    if detected["to_process"] > 0 or ordered:
        staged = spark.read.parquet(stage1)
        repair = [t.config.workspace_id for t in tenants if t.config.repair_orphans]
        if repair:
            staged = repair_orphans(store, staged, repair, base)
        stage2 = scratch_path(spark, "runs", run_id, "outcome")
        counts = Observation(f"outcome_{run_id}")
        store.with_bucket(outcome(staged, titles, embedder, configs)).observe(
            counts, *report.outcome_exprs(), F.sum(F.when(F.col("action") == "touch", 1).otherwise(0)).alias("touched")) \
            .write.parquet(stage2)
        seen = {k: int(v or 0) for k, v in counts.get.items()}
        touched = seen.pop("touched")
        record.update(seen)
        mark("enrich_embed")
        done = spark.read.parquet(stage2)
        live = done.filter(F.col("action").isin("upsert", "update"))
        moved = merge.written(done)
        write = record["with_embedding"] + record["data_only"] > 0
        pairs, up_pairs = (store.touched_partitions_with(moved, F.col("action") == "upsert") if write or touched else ([], []))
        jobs, orphans = [], Observation(f"orphans_{run_id}")
        if record["with_embedding"] > 0:
            ups = done.filter(F.col("action") == "upsert")
            vectors = merge.merge_vectors(store.read_partitions("vectors", up_pairs, base), ups, ("bucket",))
            jobs.append(lambda: store.replace_partitions("vectors", vectors, commit=commit))
        if write:
            merged = merge.merge_products(store.read_partitions("target", pairs, base), live, ("bucket",),
                                          with_vectors=False, mark_orphans=True)
            jobs.append(lambda: store.replace_partitions("target", merged, commit=commit,
                                                         finish=lambda d: merge.drop_orphans(d, orphans)))
        if write or touched:  # nothing to write starts no merge
            advanced = merge.merge_state(store.read_partitions("state", pairs, base), moved, as_of, ("bucket",))
            jobs.append(lambda: store.replace_partitions("state", advanced, commit=commit))
        in_parallel(spark, jobs)
        if write:
            record["orphans"] = int(orphans.get.get("orphans") or 0)
        mark("merge")
        if write and sink is not None:
            key = run_id if stream_id is None else f"{stream_id}-{batch_id}"
            sink.apply(live, key) if hasattr(sink, "apply") else sink(live)
            mark("sink")
    record["processed"] = record["to_process"]
    record["duration_s"] = round(time.time() - started, 3)
    record["version"] = commit.publish({f.name: record.get(f.name) for f in RUNS.fields}, workspaces, stream_id, batch_id)
    mark("commit")
    record["phases"] = phases
    return record
