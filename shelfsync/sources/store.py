"""Versioned tables of one sync deployment on a shared file system.

Layout under ``root``:

* ``target`` (product data), ``vectors`` (keys and embedding) and ``state``:
  Parquet in ``<table>/commit=<id>/workspace_id=<ws>/bucket=<b>``, with
  ``bucket = pmod(xxhash64(id), B)``.  A folder is written once, by one
  commit, and never changed.  Vectors live apart because they dominate row
  size and only upserts change them: data-only refreshes, the common run,
  never shuffle or rewrite them.
* ``manifests/<commit>``: which commit holds each live partition of each
  table, one row a partition (bounded by tenants x buckets, not by the data).
* ``versions/<number>.json``: one pointer a version, naming its manifest, its
  run record and the last batch of every stream.  It is written last, and
  only one writer can create it (:func:`~shelfsync.sources.files.create_once`).

A :class:`Commit` writes the partitions it touches into its own folders and
then publishes all tables with the one pointer.  Before that nothing is
visible; a crash leaves folders that no version names.  Readers keep the
version they began with.  Two writers that began at one version cannot both
publish: the later one is refused where a workspace of its own was changed
(:class:`CommitConflict`), and otherwise adds its partitions to the newer
version.  The batch id of a stream is in the pointer, so a replayed batch
finds its own commit, however late the driver was lost.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfsync.schema import KEYS, PRODUCT, RUNS, STATE
from shelfsync.session import scratch_path
from shelfsync.sources.files import create_once, names_in, read_text

PARTITIONS = ["workspace_id", "bucket"]
TABLES = ("target", "vectors", "state")
STREAM_ID_RE = r"^[A-Za-z0-9_.-]+$"
MANIFEST = "table string, workspace_id string, bucket int, commit string"
#: The characters that Spark escapes in a partition folder's name.
_ESCAPED = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


class CommitConflict(RuntimeError):
    """Another run changed a workspace of this one since it began."""


def bucket_of(id_col, num_buckets: int):
    return F.pmod(F.xxhash64(id_col), F.lit(num_buckets)).cast("int")


def _with_bucket_field(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType(), False)])


def _folder(workspace_id: str, bucket: int) -> str:
    escaped = _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", workspace_id)
    return f"workspace_id={escaped}/bucket={bucket}"


@dataclass(frozen=True)
class Snapshot:
    """One version: the commit that holds each live partition, the last batch of each stream."""

    version: int = -1
    partitions: dict = field(default_factory=dict)  # table -> {(workspace_id, bucket): commit}
    streams: dict = field(default_factory=dict)

    def of(self, table: str) -> dict:
        return self.partitions.get(table, {})

    def held_by(self, workspaces: set[str]) -> dict:
        return {(t, *p): c for t in TABLES for p, c in self.of(t).items() if p[0] in workspaces}


class TableStore:
    """Partitioned, versioned tables of one sync deployment under ``root``."""

    def __init__(self, spark: SparkSession, root: str, num_buckets: int = 16,
                 max_static_partitions: int = 20000, staged_commit: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.num_buckets = num_buckets
        self.max_static_partitions = max_static_partitions
        self.staged_commit = staged_commit
        data = T.StructType([f for f in PRODUCT.fields if f.name != "embedding"])
        vectors = T.StructType([f for f in PRODUCT.fields if f.name in (*KEYS, "embedding")])
        self.schemas = {"target": _with_bucket_field(data), "vectors": _with_bucket_field(vectors),
                        "state": _with_bucket_field(STATE)}
        self._layout_checked = False
        self._empty: set[str] = set()
        self._last = Snapshot()

    def check_layout(self) -> None:
        """The bucket count is part of every key's place, so it is recorded
        under the root when the store is made, and a store opened with another
        count is refused rather than given second copies of its keys."""
        if self._layout_checked:
            return
        path = f"{self.path('layout')}/num_buckets"
        create_once(self.spark, path, str(self.num_buckets))
        kept = int(read_text(self.spark, path))
        if kept != self.num_buckets:
            raise ValueError(f"store {self.root} has {kept} buckets, not {self.num_buckets}")
        self._layout_checked = True

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in names_in(self.spark, self.path("versions")) if n.endswith(".json") and n[0] != "."]

    def _pointer(self, version: int) -> str:
        return f"{self.path('versions')}/{version:020d}.json"

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The given version, or the newest one."""
        self.check_layout()
        if version is None:
            version = max(self.versions(), default=-1)
        if version == self._last.version:
            return self._last
        if version < 0:
            return Snapshot()
        pointer = json.loads(read_text(self.spark, self._pointer(version)))
        partitions: dict[str, dict] = {t: {} for t in TABLES}
        if pointer["manifest"]:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path('manifests')}/{pointer['manifest']}").collect()
            for r in rows:  # tenants x buckets x tables at most
                partitions[r["table"]][r["workspace_id"], r["bucket"]] = r["commit"]
        found = Snapshot(version, partitions, pointer["streams"])
        if version > self._last.version:
            self._last = found
        return found

    def begin(self, snapshot: Snapshot | None = None) -> Commit:
        """A commit on top of ``snapshot`` (by default the newest version)."""
        return Commit(self, snapshot or self.snapshot())

    # ------------------------------------------------------------ reading

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The live table (empty on first use), or that of an older version,
        with its fixed schema.  ``runs`` is the run log: the records that the
        versions carry."""
        if name == "runs":
            return self._runs()
        snapshot = self.snapshot(version)
        return self.read_partitions(name, list(snapshot.of(name)), snapshot)

    def _runs(self) -> DataFrame:
        self.check_layout()
        if not self.versions():
            return self.spark.createDataFrame([], RUNS)
        pointers = T.StructType([T.StructField("record", RUNS), T.StructField("version", T.LongType())])
        return (self.spark.read.schema(pointers).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                .option("pathGlobFilter", "*.json").json(self.path("versions"))
                .filter(F.col("record").isNotNull()).select("record.*", "version"))

    def read_products(self, version: int | None = None) -> DataFrame:
        """The canonical product table: product data with its vector, both of one version."""
        snapshot = self.snapshot(version)
        target, vec = (self.read_partitions(t, list(snapshot.of(t)), snapshot) for t in ("target", "vectors"))
        vec = vec.select(*KEYS, "bucket", "embedding")
        return target.join(vec, [*KEYS, "bucket"], "left").select(*[f.name for f in PRODUCT.fields])

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", bucket_of(F.col("id"), self.num_buckets))

    def touched_partitions(self, keys: DataFrame) -> list[tuple[str, int]] | DataFrame:
        """The distinct (workspace_id, bucket) pairs of ``keys``.

        The list is bounded by tenants × buckets — never by the data — so up
        to ``max_static_partitions`` pairs are fetched to name the folders to
        read.  Beyond that bound the pairs stay a DataFrame.
        """
        parts = keys.select(*PARTITIONS).distinct()
        pairs = [(r[0], r[1]) for r in parts.limit(self.max_static_partitions + 1).collect()]
        return parts if len(pairs) > self.max_static_partitions else pairs

    def touched_partitions_with(self, keys: DataFrame, subset) -> tuple:
        """:meth:`touched_partitions` of ``keys`` and of its rows matching the
        boolean column ``subset``, fetched in one job (same bound)."""
        parts = keys.groupBy(*PARTITIONS).agg(F.max(F.coalesce(subset, F.lit(False))).alias("_s"))
        rows = parts.limit(self.max_static_partitions + 1).collect()
        if len(rows) > self.max_static_partitions:
            return parts.select(*PARTITIONS), parts.filter(F.col("_s")).select(*PARTITIONS)
        return [(r[0], r[1]) for r in rows], [(r[0], r[1]) for r in rows if r[2]]

    def _empty_table(self, name: str) -> DataFrame:
        """A scan of no files (the folder is made on first use)."""
        path = f"{self.path(name)}/none"
        if name not in self._empty:
            self.spark.createDataFrame([], self.schemas[name]).write.mode("ignore").parquet(path)
            self._empty.add(name)
        return self.spark.read.schema(self.schemas[name]).parquet(path)

    def read_partitions(self, name: str, pairs: list[tuple[str, int]] | DataFrame, snapshot: Snapshot | None = None) -> DataFrame:
        """Rows of the given partitions only: just their folders are listed
        and read.  Where they are too many to name, the folders of the live
        commits are read and joined with the manifest's partitions."""
        snapshot = snapshot or self.snapshot()
        live, schema = snapshot.of(name), self.schemas[name]
        reader = self.spark.read.schema(schema).option("basePath", self.path(name))
        columns = [f.name for f in schema.fields]
        if not isinstance(pairs, DataFrame):
            held = [(p, live[p]) for p in sorted(set(pairs)) if p in live]
            if not held:
                return self._empty_table(name)
            if len(held) <= self.max_static_partitions:
                return reader.parquet(*[f"{self.path(name)}/commit={c}/{_folder(*p)}" for p, c in held]).select(*columns)
        elif not live:
            return self._empty_table(name)
        rows = [(*p, c) for p, c in live.items()]
        manifest = self.spark.createDataFrame(rows, "workspace_id string, bucket int, commit string")
        everything = reader.parquet(*sorted({f"{self.path(name)}/commit={c}" for c in live.values()}))
        found = everything.join(manifest, [*PARTITIONS, "commit"], "left_semi").select(*columns)
        if isinstance(pairs, DataFrame):
            return found.join(pairs, PARTITIONS, "left_semi")
        wanted = self.spark.createDataFrame(sorted(set(pairs)), "workspace_id string, bucket int")
        return found.join(wanted, PARTITIONS, "left_semi")

    def touched(self, name: str, keys: DataFrame, snapshot: Snapshot | None = None) -> DataFrame:
        """Rows of the live table in the partitions named by ``keys``."""
        return self.read_partitions(name, self.touched_partitions(keys), snapshot)

    # ------------------------------------------------------------ writing

    def replace_partitions(self, name: str, df: DataFrame, staged: bool | None = None, finish=None,
                           commit: Commit | None = None) -> None:
        """Replace exactly the partitions present in ``df``, as part of
        ``commit`` (or as a commit of its own).

        The rows go to a folder of the commit's own, so ``df`` may read the
        very partitions it replaces.  ``staged=True`` (or the store default)
        first materialises ``df`` in the scratch folder and copies it in, for
        file systems where a second copy is wanted.  ``finish`` is applied
        after the rebalance, in the writing stage (e.g. an observation that
        must sit in the final stage).
        """
        own = commit or self.begin()
        own.write(name, df, self.staged_commit if staged is None else staged, finish)
        if commit is None:
            own.publish()


class Commit:
    """New partitions of some tables, published together or not at all."""

    def __init__(self, store: TableStore, base: Snapshot):
        self.store, self.base, self.id = store, base, uuid.uuid4().hex
        self.changed: dict[tuple[str, str, int], str] = {}

    def write(self, name: str, df: DataFrame, staged: bool = False, finish=None) -> None:
        store, schema = self.store, self.store.schemas[name]
        # Rows arrive hashed on the merge key, so every task would hold rows
        # of nearly every touched partition and write a file into each: tasks
        # x partitions small files.  REBALANCE shuffles by partition instead;
        # AQE then splits an oversized partition over several tasks and merges
        # small ones, so each directory gets a few right-sized files.
        out = df.hint("rebalance", *PARTITIONS)
        if finish is not None:
            out = finish(out)
        out = out.select(*[f.name for f in schema.fields])
        if staged:
            copy = scratch_path(store.spark, "staging", name)
            out.write.partitionBy(*PARTITIONS).parquet(copy)
            out = store.spark.read.schema(schema).parquet(copy)
        folder = f"{store.path(name)}/commit={self.id}"
        out.write.partitionBy(*PARTITIONS).parquet(folder)
        files = store.spark.read.schema(schema).parquet(folder).inputFiles()
        for part in {f.rsplit("/", 3)[1] + "/" + f.rsplit("/", 3)[2] for f in files}:
            workspace, bucket = (x.split("=", 1)[1] for x in part.split("/"))
            # inputFiles gives URIs: what Spark escaped in the name is escaped once more there.
            self.changed[name, unquote(unquote(workspace)), int(bucket)] = self.id

    def publish(self, record: dict | None = None, workspaces: list[str] | tuple = (), stream_id: str | None = None,
                batch_id: int | None = None) -> int:
        """Make the new partitions visible in one step; returns the version.
        ``workspaces`` are those this run read or wrote; if another run has
        changed one of them since, nothing is published."""
        store = self.store
        mine = {p[1] for p in self.changed} | set(workspaces)
        before = self.base.held_by(mine)
        now = self.base
        while True:
            partitions = {t: dict(now.of(t)) for t in TABLES}
            for (t, workspace, bucket), c in self.changed.items():
                partitions[t][workspace, bucket] = c
            manifest = f"{self.id}-{now.version + 1}" if any(partitions.values()) else None
            if manifest:
                rows = [(t, *p, c) for t in TABLES for p, c in partitions[t].items()]
                (store.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{store.path('manifests')}/{manifest}"))
            streams = {**now.streams, **({stream_id: batch_id} if stream_id is not None else {})}
            pointer = {"version": now.version + 1, "commit": self.id, "manifest": manifest, "streams": streams,
                       "record": record and {k: v.isoformat(timespec="microseconds") if isinstance(v, dt.datetime) else v
                                             for k, v in record.items()}}
            if create_once(store.spark, store._pointer(now.version + 1), json.dumps(pointer)):
                store._last = Snapshot(now.version + 1, partitions, streams)
                return now.version + 1
            now = store.snapshot()
            moved = now.held_by(mine) != before
            again = stream_id is not None and now.streams.get(stream_id, -1) >= batch_id
            if moved or again:
                raise CommitConflict(f"version {now.version} changed what this run began from (version {self.base.version})")


__all__ = ["Commit", "CommitConflict", "Snapshot", "TableStore", "bucket_of", "PARTITIONS", "KEYS"]
