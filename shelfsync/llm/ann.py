"""Approximate nearest neighbours by collision counting.

Each vector is projected on M random lines; every line is one sorted array.  A
query's window on each line starts around its own projection and widens step
by step (virtual rehashing: no hash table is rebuilt).  Vectors that fall in at
least ``SHARE`` of the windows are verified on the original vectors.  A query
stops when a vector as near as its k-th best would have collided often enough
with near certainty; otherwise its windows widen until they hold everything.

Nearness is the largest inner product.  With an extra coordinate
sqrt(longest^2 - |x|^2) on the vectors and 0 on the queries, the largest inner
product is the smallest distance, which is what projections preserve.

Scale: vectors are dealt to shards by a hash, queries to chunks; a shard and a
chunk of bounded size meet in one task (the stated query set against all
rows, in blocks).  Each task returns k rows a query, merged exactly.  Equal
vectors are indexed once, with so many of the smallest ids that k are left
without the rows of any one id (k + 1 where ids are unique, 2 k at most), which
is all that can ever be among the nearest, so thousands of copies cost one
verification.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part; vectors of another dimension never meet; a row with a
null id takes no part; rows with the same id are different rows, a query never
meets any row of its own id, and repeated query rows are one query; fewer candidates than k are all returned;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from shelfsync.llm.common import ship

LINES, SHARE, WIDEN = 20, 0.6, 1.8
#: Collision probability at the k-th distance at which a query stops.
SURE = 0.8
SHARD_ROWS, CHUNK_ROWS = 16_384, 2_048
K = 20
SEED = 7


def valid(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, dim`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull())
            .filter(F.col("v").isNotNull() & fine).filter(F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")))


def _inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed coordinate by coordinate: equal vectors get equal scores wherever they lie."""
    acc = np.zeros(x.shape[1])
    for d in range(x.shape[0]):
        acc += x[d] * q[d]
    return acc


def _smallest(ids: np.ndarray, k: int) -> np.ndarray:
    """Of sorted ids, those that hold the k smallest once any one id is left out."""
    if len(ids) <= k + 1:
        return ids
    ids = ids[np.arange(len(ids)) - np.searchsorted(ids, ids) < k]
    return ids[:k + int(np.unique(ids[:k], return_counts=True)[1].max())] if k else ids[:1]


class Shard:
    """Sorted projections of distinct vectors, each with its smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, lines: int = LINES, seed: int = SEED):
        order = np.lexsort((ids,))
        ids, vectors = ids[order], vectors[order]
        _, first, which = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).reshape(-1),
                                    return_index=True, return_inverse=True)
        self.vectors = vectors[first]
        by = np.argsort(which, kind="stable")
        cut = np.searchsorted(which[by], np.arange(len(first) + 1))
        self.ids = [_smallest(ids[by[cut[i]:cut[i + 1]]], k) for i in range(len(first))]
        # The classes of ids that stand in several rows.
        several = np.flatnonzero((ids[1:] == ids[:-1])) if len(ids) > 1 else []
        self.of = {i: np.unique(which[np.searchsorted(ids, i):np.searchsorted(ids, i, "right")]) for i in np.unique(ids[several])}
        self.k = k
        rng = np.random.default_rng(seed)
        dim = vectors.shape[1]
        self.directions = rng.standard_normal((dim, lines))
        norms = (self.vectors ** 2).sum(1)
        self.longest2 = float(norms.max())
        extra = np.sqrt(np.maximum(self.longest2 - norms, 0.0))
        # On each line: the extra coordinate has a direction of its own; queries have 0 there.
        self.at = self.vectors @ self.directions + extra[:, None] * rng.standard_normal(lines)
        self.order = np.argsort(self.at, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.at, self.order, 0)
        self.lines_order = np.ascontiguousarray(self.order.T)
        self.lines_sorted = np.ascontiguousarray(self.sorted.T)

    def search(self, query: np.ndarray, own: int) -> list[tuple[float, int]]:
        """(score, vec_id) of the nearest found, nearest first, without rows of id ``own``."""
        n, lines = self.sorted.shape
        need = math.ceil(SHARE * lines)
        at = query @ self.directions
        here = np.array([np.searchsorted(self.sorted[:, p], at[p]) for p in range(lines)])
        start = np.minimum(here + 2 * self.k, n - 1)
        radius = max(float(np.median(np.abs(self.sorted[start, np.arange(lines)] - at))), 1e-12)
        q2 = float((query ** 2).sum())
        rough = np.full(n, -np.inf)  # scores but for the order of addition
        everything = None
        seen = np.zeros(n, bool)
        mine, alone = {}, np.zeros(n, bool)  # rows of a repeated own id; classes of nothing else
        for i in self.of.get(own, ()):
            mine[i] = int((self.ids[i] == own).sum())
            alone[i] = mine[i] == len(self.ids[i])
        counts = np.zeros(n, np.int64)
        low, high = here.copy(), here.copy()
        while True:
            rings = []
            for p in range(lines):
                line, order = self.lines_sorted[p], self.lines_order[p]
                lo, hi = line.searchsorted(at[p] - radius), line.searchsorted(at[p] + radius, "right")
                rings += [order[lo:low[p]], order[high[p]:hi]]  # what the wider window adds
                low[p], high[p] = min(lo, low[p]), max(hi, high[p])
            whole = not low.any() and bool((high == n).all())
            counts += np.bincount(np.concatenate(rings), minlength=n)
            new = np.flatnonzero((counts >= need) & ~seen)
            if len(new):
                # Many at once: all in storage order is cheaper than picking them out.
                if everything is None and 8 * len(new) > n:
                    everything = self.vectors @ query
                rough[new] = self.vectors[new] @ query if everything is None else everything[new]
                seen[new] = True
            if whole:
                break
            known = np.flatnonzero(seen & ~alone)
            have = sum(min(len(self.ids[i]) - max(mine.get(i, 0) - 1, 0), self.k + 1) for i in known[:self.k + 1]) if len(known) <= self.k else self.k + 1
            if have > self.k:
                # One more than k classes: the query's own row may be among them.
                most = min(self.k + 1, len(known))
                worst = np.partition(rough[known], -most)[-most]
                far = math.sqrt(max(q2 + self.longest2 - 2 * worst, 0.0))
                if far == 0 or math.erf(radius / (far * math.sqrt(2))) >= SURE:
                    break
            radius *= WIDEN
        known = np.flatnonzero(seen & ~alone)
        if len(known) > self.k + 1:
            # Rounding moves a score by far less than this.
            room = 1e-9 * math.sqrt(self.longest2 * q2)
            known = known[rough[known] >= np.partition(rough[known], -(self.k + 1))[-(self.k + 1)] - room]
        scores = _inner(np.ascontiguousarray(self.vectors[known].T), query)
        found: list[tuple[float, int]] = []
        for i in np.argsort(-scores, kind="stable"):
            if len(found) >= self.k and scores[i] < found[self.k - 1][0]:
                break
            found.extend((float(scores[i]), int(v)) for v in self.ids[known[i]] if v != own)
            found.sort(key=lambda x: (-x[0], x[1]))
            del found[self.k:]
        return found


def _search(k: int):
    def run(shard, chunk):
        import pyarrow as pa

        names = ["query_id", "query", "vec_id", "score"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        out: list[tuple] = []
        if shard.num_rows and chunk.num_rows:
            dim = shard.column("dim")[0].as_py()

            def matrix(t):
                return t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)

            index = Shard(shard.column("vec_id").to_numpy(), matrix(shard), k)
            for qid, which, q in zip(chunk.column("vec_id").to_pylist(), chunk.column("query").to_pylist(), matrix(chunk),
                                     strict=True):
                out.extend((qid, which, v, s) for s, v in index.search(q, qid))
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for
    each row where ``is_query`` (a condition on ``vec_id``) holds."""
    ship(vectors.sparkSession)
    rows = valid(vectors)
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, chunks = max(1, math.ceil(n["n"] / SHARD_ROWS)), max(1, math.ceil(n["q"] / CHUNK_ROWS))
    base = (rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    queries = (rows.filter(is_query).withColumn("query", F.xxhash64("v")).dropDuplicates(["vec_id", "v"])
               .withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).cast("int"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    keys = ["dim", "shard", "chunk"]
    found = base.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        _search(k), "query_id long, query long, vec_id long, score double")
    best = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
