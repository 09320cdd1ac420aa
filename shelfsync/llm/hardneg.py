"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are quantised to integers, ordered by label and by their place on a
Hilbert curve (over the dimensions that vary most), and written as Parquet
blocks of at most ``BLOCK_ROWS`` rows, each with a zone map: the smallest and
largest value of every dimension.  Interval arithmetic on an anchor and a zone
map bounds all inner products of the block from both sides.  An anchor asks
for windows of scores: its positives' window has no limits, each positive's
negatives lie between two shares of its score.  A block is read for an anchor
only where its bounds meet a window, and where its upper bound reaches the
k-th best that the lower bounds of other blocks warrant.

Scale: zone maps and anchors meet in pieces of bounded size (``ZONES``,
``ANCHORS``); a block travels only to the pieces of anchors that asked for it,
and each piece of blocks returns k rows a window, merged exactly.  Nothing
grows with a label's or a vector's share of the rows.

Edge cases: a row with a null vec_id, label or vector, or any null or
non-finite component takes no part, nor one with a component beyond ``LARGEST``
once quantised (its scores would not fit 64 bits); vectors of another
dimension never meet; rows that share a vec_id are different rows, but an
anchor never meets a row of its own vec_id, and repeated anchor rows are one;
a negative positive score leaves an empty window; fewer rows than asked for
are all returned; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfsync.llm.common import map_arrow, rows_of, ship, stage

SCALE = 256
#: Rows of a block; blocks of a piece that is read together; zone maps and anchors that meet in one task.
BLOCK_ROWS, PIECE, ZONES, ANCHORS = 256, 64, 8192, 2048
#: Numbers of pieces of anchors that may be broadcast (two numbers each).
BROADCAST_ROWS = 1 << 19
#: The curve runs over so many dimensions with so many bits each.
CURVE_DIMS, CURVE_BITS = 12, 5
LARGEST = 1 << 26
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of its positive's.
LOW_PERCENT, HIGH_PERCENT = 30, 90
_FAR = np.iinfo(np.int64).max


def valid(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """``vec_id, label, q, dim, anchor`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.floor(x * SCALE)) <= LARGEST))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine)
            .select("vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("q"), F.size("v").alias("dim"),
                    F.coalesce(is_anchor, F.lit(False)).alias("anchor")))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of cell coordinates (below 2 ** bits) on the
    Hilbert curve through them (Skilling's transposition, 2004)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(dims):
            up = (x[i] & step) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        step >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    step = 1 << (bits - 1)
    while step > 1:
        flip ^= np.where(x[dims - 1] & step, step - 1, 0)
        step >>= 1
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _spreads(batches: Iterator) -> Iterator:
    import pyarrow as pa

    sums: dict[int, list] = {}
    for b in batches:
        for q in b.column(0).to_pylist():
            v = np.array(q, np.float64)
            s = sums.setdefault(len(v), [0, np.zeros(len(v)), np.zeros(len(v)), np.full(len(v), np.inf), np.full(len(v), -np.inf)])
            s[0] += 1
            s[1] += v
            s[2] += v * v
            np.minimum(s[3], v, out=s[3])
            np.maximum(s[4], v, out=s[4])
    for dim, (n, one, two, lo, hi) in sums.items():
        cols = {"dim": np.full(dim, dim, np.int32), "at": np.arange(dim, dtype=np.int32), "n": np.full(dim, n, np.int64),
                "one": one, "two": two, "lo": lo, "hi": hi}
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols.values()], names=list(cols))


def curve_layout(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By vector length: the dimensions of the curve, most varying first, their smallest and largest values."""
    sums = rows.select("q").transform(map_arrow, _spreads, "dim int, at int, n long, one double, two double, lo double, hi double")
    found = (sums.groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"),
                                           F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .withColumn("spread", F.col("two") / F.col("n") - (F.col("one") / F.col("n")) ** 2)
             .withColumn("rank", F.row_number().over(W.partitionBy("dim").orderBy(F.desc("spread"), "at")))
             .filter(F.col("rank") <= CURVE_DIMS).orderBy("dim", "rank").collect())  # a few rows a vector length
    out: dict[int, tuple] = {}
    for dim in {r["dim"] for r in found}:
        mine = [r for r in found if r["dim"] == dim]
        out[dim] = tuple(np.array([r[c] for r in mine]) for c in ("at", "lo", "hi"))
    return out


def _keyed(layout):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            key = np.zeros(b.num_rows, np.int64)
            dims = b.column("dim").to_numpy()
            q = b.column("q").to_pylist()
            for dim in np.unique(dims):
                if dim not in layout:  # vectors of no components
                    continue
                at, lo, hi = layout[dim]
                here = np.flatnonzero(dims == dim)
                v = np.array([q[i] for i in here], np.float64)[:, at]
                cells = np.floor((v - lo) / np.maximum(hi - lo, 1) * ((1 << CURVE_BITS) - 1))
                key[here] = hilbert(cells, CURVE_BITS)
            packed = pa.array([np.array(x, np.int64).tobytes() for x in q], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("dim"), b.column("anchor"),
                                              pa.array(key), packed], names=["vec_id", "label", "dim", "anchor", "key", "q"])

    return run


def _packed(most: int):
    """Blocks of the sorted rows of a task, of at most ``most`` rows."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        first, seq, out = TaskContext.get().partitionId() << 32, 0, []

        def block(dim: int, label: int, ids: list[int], vectors: list[bytes]) -> dict:
            v = np.frombuffer(b"".join(vectors), np.int64).reshape(len(ids), dim)
            return {"block": first + seq, "dim": dim, "label": label, "n": len(ids), "ids": np.array(ids, np.int64).tobytes(),
                    "q": v.tobytes(), "lo": v.min(0).tobytes(), "hi": v.max(0).tobytes()}

        here, ids, vectors = None, [], []
        for dim, label, vec_id, q in rows_of(batches):
            if ids and (here != (dim, label) or len(ids) >= most):
                out.append(block(*here, ids, vectors))
                seq += 1
                ids, vectors = [], []
                if len(out) >= 64:
                    yield pa.RecordBatch.from_pylist(out, _BLOCK_ARROW())
                    out = []
            here = (dim, label)
            ids.append(vec_id)
            vectors.append(q)
        if ids:
            out.append(block(*here, ids, vectors))
        if out:
            yield pa.RecordBatch.from_pylist(out, _BLOCK_ARROW())

    return run


def _BLOCK_ARROW():
    import pyarrow as pa

    return pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("label", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()),
                      ("q", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary())])


def blocks_of(keyed: DataFrame) -> DataFrame:
    """``block, dim, label, n, ids, q, lo, hi``: the rows in curve order, packed."""
    order = ["dim", "label", "key", "vec_id", "row"]  # ``row`` parts the copies of one row among tasks
    rows = keyed.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("dim", "label", "vec_id", "q").transform(
        map_arrow, _packed(BLOCK_ROWS), "block long, dim int, label long, n int, ids binary, q binary, lo binary, hi binary")


def anchors_of(keyed: DataFrame) -> DataFrame:
    """``anchor, piece, vec_id, label, dim, q``: distinct anchor rows in pieces
    that are near on the curve and hold about ``ANCHORS``."""
    rows = keyed.filter("anchor").select("vec_id", "label", "dim", "q", "key").dropDuplicates(["vec_id", "label", "dim", "q"])
    n = rows.count()
    ranges = math.ceil(n / ANCHORS)
    if ranges < 2:
        return rows.withColumn("piece", F.lit(0).cast("long")).withColumn("anchor", F.monotonically_increasing_id())
    cuts = rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("c")).first()["c"]
    place = F.aggregate(F.array(*[F.lit(c) for c in sorted(set(cuts))]), F.lit(0), lambda a, c: a + F.when(F.col("key") > c, 1).otherwise(0))
    rows = rows.withColumn("range", place)
    parts = rows.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).alias("parts"))  # many anchors at one place
    piece = F.col("range") * (1 << 32) + F.pmod(F.xxhash64("vec_id", "q"), F.col("parts"))
    return rows.join(parts, "range").withColumn("piece", piece.cast("long")).withColumn("anchor", F.monotonically_increasing_id())


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of integers, exactly: in doubles where they hold every partial sum."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor (row of ``q``) and zone map (rows of ``lo`` and ``hi``): the
    least and the greatest inner product that a vector within the zone can have."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return _product(up, lo.T) + _product(down, hi.T), _product(up, hi.T) + _product(down, lo.T)


def _matrix(column, dim: int) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), dim)


class Windows:
    """The windows of one piece's anchors: arrays of a row a window, sorted by anchor."""

    def __init__(self, table, dim: int):
        order = np.lexsort((table.column("w").to_numpy(), table.column("anchor").to_numpy()))
        table = table.take(order)
        self.anchor, self.w, self.own, self.label, self.low, self.high = (
            table.column(c).to_numpy() for c in ("anchor", "w", "vec_id", "label", "low", "high"))
        self.anchors, self.first, self.of = np.unique(self.anchor, return_index=True, return_inverse=True)
        self.q = _matrix(table.column("q").take(self.first), dim)


def wanted(win: Windows, labels: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, same: bool) -> np.ndarray:
    """Whether each block must be read for each anchor (anchors x blocks)."""
    least, most = bounds(win.q, lo, hi)
    out = np.zeros(least.shape, bool)
    for at in range(0, len(win.of), 256):
        part = slice(at, at + 256)
        who = win.of[part]
        mine, low, high = win.label[part, None], win.low[part, None], win.high[part, None]
        fits = (labels == mine) == same
        lb, ub = least[who], most[who]
        # Blocks that lie in the window whole warrant k rows (and one of the anchor's own) at their lower bounds or above.
        inside = np.where(fits & (lb >= low) & (ub <= high), lb, -_FAR)
        order = np.argsort(-inside, axis=1, kind="stable")
        held = np.cumsum(np.where(np.take_along_axis(inside, order, 1) > -_FAR, n[order], 0), axis=1) >= k + 1
        kth = np.where(held.any(1), np.take_along_axis(np.take_along_axis(inside, order, 1), held.argmax(1)[:, None], 1)[:, 0], -_FAR)
        need = fits & (lb <= high) & (ub >= np.maximum(low, kth[:, None]))
        np.logical_or.at(out, who, need)
    return out


def _choose(k: int, same: bool):
    """Of the zone maps of a task: the blocks that its piece of anchors must read, each with those anchors."""
    def run(zones, windows):
        import pyarrow as pa

        names = ["piece", "block", "anchors"]
        types = [pa.int64(), pa.int64(), pa.binary()]
        out: list[tuple] = []
        if zones.num_rows and windows.num_rows:
            dim, piece = zones.column("dim")[0].as_py(), windows.column("piece")[0].as_py()
            win = Windows(windows, dim)
            # The k + 1 rows warranted must not be copies of the anchor's own row: those of its vec_id could be many.
            need = wanted(win, zones.column("label").to_numpy(), zones.column("n").to_numpy(), _matrix(zones.column("lo"), dim),
                          _matrix(zones.column("hi"), dim), k + int(windows.column("copies")[0].as_py()), same)
            for j, block in enumerate(zones.column("block").to_pylist()):
                if need[:, j].any():
                    out.append((piece, block, win.anchors[need[:, j]].tobytes()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


class Best:
    """The k best rows of each window so far."""

    def __init__(self, windows: int, k: int):
        self.k, self.kth = k, np.full(windows, -_FAR)
        self.kept, self.new, self.held = [np.empty(0, np.int64)] * 3, [], 0

    def add(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.new.append((which, ids, scores))
        self.held += len(which)
        if self.held > 1 << 18:
            self.settle()

    def settle(self) -> None:
        which, ids, scores = (np.concatenate([old, *(x[i] for x in self.new)]) for i, old in enumerate(self.kept))
        order = np.lexsort((ids, -scores, which))
        which, ids, scores = which[order], ids[order], scores[order]
        rank = np.arange(len(which)) - np.searchsorted(which, which)
        last = rank == self.k - 1
        self.kth[which[last]] = scores[last]
        keep = rank < self.k
        self.kept, self.new, self.held = [which[keep], ids[keep], scores[keep]], [], 0


def _read(k: int, same: bool):
    """The k best rows of each window among the blocks of a task."""
    def run(blocks, windows):
        import pyarrow as pa

        names = ["anchor", "w", "vec_id", "score"]
        if not blocks.num_rows or not windows.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        dim = blocks.column("dim")[0].as_py()
        win = Windows(windows, dim)
        best = Best(len(win.of), k)
        label, ids, q, asked = (blocks.column(c).to_pylist() for c in ("label", "ids", "q", "anchors"))
        _, most = bounds(win.q, _matrix(blocks.column("lo"), dim), _matrix(blocks.column("hi"), dim))
        for b in np.argsort(-most.max(0), kind="stable"):  # the most promising first
            who = np.searchsorted(win.anchors, np.frombuffer(asked[b], np.int64))
            xid = np.frombuffer(ids[b], np.int64)
            x = np.frombuffer(q[b], np.int64).reshape(len(xid), dim)
            for part in range(0, len(who), 128):
                some = who[part:part + 128]
                place = np.full(len(win.anchors), -1)
                place[some] = np.arange(len(some))
                rows = np.flatnonzero(place[win.of] >= 0)
                # Windows whose k-th best the block cannot reach any more are done with it.
                rows = rows[most[win.of[rows], b] >= np.maximum(best.kth[rows], win.low[rows])]
                rows = rows[(win.label[rows] == label[b]) == same]
                if not len(rows):
                    continue
                s = _product(win.q[some], x.T)[place[win.of[rows]]]
                hit = ((s >= np.maximum(win.low[rows], best.kth[rows])[:, None]) & (s <= win.high[rows, None])
                       & (xid != win.own[rows, None]))
                i, j = np.nonzero(hit)
                best.add(rows[i], xid[j], s[i, j])
        best.settle()
        which, found, scores = best.kept
        return pa.table([pa.array(x.astype(np.int64)) for x in (win.anchor[which], win.w[which], found, scores)], names=names)

    return run


def best_in_windows(blocks: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
    """``anchor, w, rank, vec_id, score``: the k best rows of each window, of
    the anchor's label (``same``) or of any other.  ``windows`` has a row a
    window: ``anchor, piece, vec_id, label, dim, q, copies, w, low, high``
    (the limits included); ``blocks`` is a staged :func:`blocks_of`."""
    spark = blocks.sparkSession
    ship(spark)
    n = blocks.count()
    zone_parts, read_parts = max(1, math.ceil(n / ZONES)), max(1, math.ceil(n / PIECE))
    pieces = windows.select(F.col("dim").alias("of"), F.col("piece").alias("to")).distinct()
    if pieces.count() <= BROADCAST_ROWS:  # all zone maps share few lengths: without a broadcast, one key
        pieces = F.broadcast(pieces)
    zones = (blocks.select("block", "dim", "label", "n", "lo", "hi")
             .withColumn("part", F.pmod(F.xxhash64("block"), F.lit(zone_parts)).cast("int"))
             .join(pieces, F.col("dim") == F.col("of")).withColumnRenamed("to", "piece").drop("of"))
    keys = ["dim", "piece", "part"]
    spread = windows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(zone_parts - 1))))
    chosen = zones.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(
        _choose(k, same), "piece long, block long, anchors binary")
    chosen = stage(chosen, "hardneg-chosen")
    to_read = blocks.join(chosen, "block").withColumn("part", F.pmod(F.xxhash64("block", F.lit(1)), F.lit(read_parts)).cast("int"))
    asked = chosen.select("piece", F.pmod(F.xxhash64("block", F.lit(1)), F.lit(read_parts)).cast("int").alias("part")).distinct()
    found = to_read.groupBy(*keys).cogroup(windows.join(asked, "piece").groupBy(*keys)).applyInArrow(
        _read(k, same), "anchor long, w long, vec_id long, score long")
    order = W.partitionBy("anchor", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    rows = valid(vectors, is_anchor)
    layout = curve_layout(rows)
    keyed = stage(rows.transform(map_arrow, _keyed(layout), "vec_id long, label long, dim int, anchor boolean, key long, q binary"),
                  "hardneg-keyed")
    blocks = stage(blocks_of(keyed), "hardneg-blocks")
    anchors = stage(anchors_of(keyed), "hardneg-anchors")
    # So many rows of one anchor vec_id there are at most; they are never its candidates.
    copies = keyed.filter("anchor").groupBy("vec_id").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]
    anchors = anchors.withColumn("copies", F.lit(copies).cast("long"))
    whole = anchors.withColumns({"w": F.lit(0).cast("long"), "low": F.lit(-_FAR), "high": F.lit(int(_FAR))})
    pos = stage(best_in_windows(blocks, whole, positives, True), "hardneg-positives")
    pos = pos.select("anchor", F.col("rank").cast("long").alias("w"), F.col("vec_id").alias("positive_id"),
                     F.col("score").alias("positive_score"))
    wide = F.col("positive_score").cast("decimal(20,0)")
    shares = pos.select("anchor", "w", F.call_function("div", wide * LOW_PERCENT + 99, F.lit(100)).alias("low"),
                        F.call_function("div", wide * HIGH_PERCENT, F.lit(100)).alias("high"))
    limits = shares.filter((F.col("low") >= 0) & (F.col("low") <= F.col("high")))
    neg = best_in_windows(blocks, anchors.join(limits, "anchor"), negatives, False)
    return (neg.select("anchor", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pos, ["anchor", "w"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


#: The same rows in DuckDB's SQL: every row scored against every anchor.
HARD_NEGATIVES_SQL = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM {{vectors}} WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
        CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE {{anchors}}),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LOW_PERCENT} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH_PERCENT} * p.score
QUALIFY rank <= {NEGATIVES}
"""
