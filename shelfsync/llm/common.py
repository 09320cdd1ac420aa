"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import time
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsync.session import scratch_path

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application, so its
    functions run there wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    code = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(code, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(code))
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package's code at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def release(spark: SparkSession) -> None:
    """Shuffle files of finished work go when the driver's garbage does: ask
    for that now, not when memory is short.  The last job's plan is held by
    the events that report its end, so they get a moment to be delivered."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, so
    an executor lost later never repeats the work before."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def word_count(text):
    """Words of a text column (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def rows_of(batches: Iterator) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def grouped(rows: Iterator[tuple], key) -> Iterator[tuple]:
    """(key, iterator of rows) of rows that come sorted by ``key``; one row is
    held at a time, so a group of any size streams through."""
    from itertools import groupby

    yield from groupby(rows, key)


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b`` long, a <> b): one row
    ``(node, component)`` per node, the component named by its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each
    round hangs neighbours on the smallest known node.  Grouped minima
    pre-aggregate before the shuffle and the join back can be split where a
    hub is skewed.  Rounds are cut by written tables; only a checksum of the
    edges reaches the driver.
    """
    def staged(df: DataFrame) -> DataFrame:
        return stage(df, name)

    def checksum(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    cur = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = checksum(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        # Large star: every neighbour above u hangs on the smallest of u and its neighbours.
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (both.join(low, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b")).distinct())
        # Small star: u and its smaller neighbours hang on the smallest of them.
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low2, "a")
        nxt = (hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(low2.select("a", F.col("m").alias("b")))
               .filter(F.col("a") != F.col("b")).distinct())
        cur = staged(nxt)
        now = checksum(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled: every node hangs on its root directly.
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
