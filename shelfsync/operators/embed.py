"""Embedding of new rows (M1–M5) and the outcome split.

Two embedders share one contract — rows in, rows plus ``embedding`` (NULL
when it failed) and ``embed_error`` out:

* ``embed_with_table`` joins a precomputed vector table (the cheap path at
  scale: embed once, join many);
* ``embed_with_function`` calls a batch function inside ``mapInPandas`` on
  the distinct texts, ``batch_size`` texts per call; a failing call leaves
  its whole batch without vectors and the run goes on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfsync.operators.normalize import embedding_text

EMBED_TEXT = "embed_text"


def with_embed_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn(EMBED_TEXT, embedding_text(rows))


def embed_with_table(rows: DataFrame, vectors: DataFrame, row_key: str, table_key: str,
                     vector_col: str = "embedding", workspace_col: str | None = None) -> DataFrame:
    """Left join on ``row_key`` = ``table_key``, and on the workspace where
    ``workspace_col`` names it (the table key must be unique).
    Only new rows are looked up; changed rows keep whatever the target has."""
    v = vectors.select(F.col(table_key).cast("string").alias("_ek"),
                       F.col(vector_col).cast("array<float>").alias("embedding"),
                       *([F.col(workspace_col).alias("_ew")] if workspace_col else []))
    is_new = F.col("status") == "new"
    match = F.col(row_key).cast("string") == F.col("_ek")
    if workspace_col:
        match = match & (F.col("workspace_id") == F.col("_ew"))
    new = rows.filter(is_new).join(v, match, "left").drop("_ek", "_ew")
    new = new.withColumn("embed_error", F.when(F.col("embedding").isNull(), F.lit("no vector")))
    rest = (rows.filter(~is_new).withColumn("embedding", F.lit(None).cast("array<float>"))
            .withColumn("embed_error", F.lit(None).cast("string")))
    return new.unionByName(rest)


def _batched(fn: Callable[[list[str]], Sequence], batch_size: int):
    def run(batches):
        for pdf in batches:
            texts = pdf[EMBED_TEXT].tolist()
            vecs: list = [None] * len(texts)
            errs: list = [None] * len(texts)
            for start in range(0, len(texts), batch_size):
                chunk = texts[start:start + batch_size]
                try:
                    got = list(fn(chunk))
                except Exception as e:  # one failed batch, not a failed run
                    for i in range(start, start + len(chunk)):
                        errs[i] = f"{type(e).__name__}: {e}"
                    continue
                for j in range(len(chunk)):
                    if j < len(got) and got[j] is not None:
                        vecs[start + j] = np.asarray(got[j], dtype=np.float32).tolist()
                    else:
                        errs[start + j] = "short reply"
            yield pd.DataFrame({EMBED_TEXT: texts, "embedding": vecs, "embed_error": errs})
    return run


def embed_texts(texts: DataFrame, fn: Callable, batch_size: int = 50,
                concurrency: int | None = None) -> DataFrame:
    """(embed_text, embedding, embed_error) for each distinct text.  With
    ``concurrency``, at most that many calls are in flight (one per
    partition), however many executors the cluster has; without, the
    planner sizes the tasks by bytes."""
    distinct = texts.select(EMBED_TEXT).distinct()
    if concurrency:
        distinct = distinct.repartition(concurrency)
    return distinct.mapInPandas(_batched(fn, batch_size),
                                f"{EMBED_TEXT} string, embedding array<float>, embed_error string")


def embed_with_function(rows: DataFrame, fn: Callable, batch_size: int = 50,
                        concurrency: int | None = None) -> DataFrame:
    """Embeds the distinct texts of new rows once and joins the vectors back."""
    rows = rows if EMBED_TEXT in rows.columns else with_embed_text(rows)
    is_new = F.col("status") == "new"
    new = rows.filter(is_new)
    vecs = embed_texts(new, fn, batch_size, concurrency)
    new = new.join(vecs, EMBED_TEXT, "left")
    rest = (rows.filter(~is_new).withColumn("embedding", F.lit(None).cast("array<float>"))
            .withColumn("embed_error", F.lit(None).cast("string")))
    return new.unionByName(rest)


def check_width(rows: DataFrame, dims: dict[str, int]) -> DataFrame:
    """A vector whose width is not its workspace's in ``dims`` is a failed
    embedding: no vector, and an error that says so."""
    by_dim: dict[int, list[str]] = {}
    for ws, dim in dims.items():
        by_dim.setdefault(dim, []).append(ws)
    for dim, workspaces in sorted(by_dim.items()):
        wrong = F.col("workspace_id").isin(workspaces) & F.col("embedding").isNotNull() & (F.size("embedding") != dim)
        error = F.concat(F.lit("vector of width "), F.size("embedding").cast("string"), F.lit(f", not {dim}"))
        rows = rows.withColumns({"embed_error": F.when(wrong, error).otherwise(F.col("embed_error")),
                                 "embedding": F.when(~wrong, F.col("embedding"))})
    return rows


def with_action(rows: DataFrame) -> DataFrame:
    """upsert = new with vector; update = changed (data only); drop = new
    without vector — not written, state not advanced, retried next run; touch =
    unchanged row of a newer snapshot (only its order moves, in the state)."""
    is_new = F.col("status") == "new"
    action = (F.when(is_new & F.col("embedding").isNotNull(), "upsert")
              .when(is_new, "drop").when(F.col("status") == "touch", "touch").otherwise("update"))
    return rows.withColumn("action", action)


_TOKEN = re.compile(r"[a-z0-9]+")


def hashing_embedder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A deterministic local embedder: signed feature hashing of lower-cased
    word tokens, L2-normalised.  Stands in for a remote model in tests and
    benches; any callable with the same contract can replace it."""
    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for tok in _TOKEN.findall((t or "").lower()):
                h = zlib.crc32(tok.encode())
                out[i, h % dim] += 1.0 if (h >> 31) & 1 else -1.0
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms == 0, 1.0, norms)
    return embed
