"""Duplicate keys in one source.

Two forms with one result: ``dedupe_keys`` reads its rows once and sorts them
all (struct buffers rule out hash aggregation); ``dedupe_repeated`` reads them
again and sorts only the rows of repeated keys, for sources that give the same
rows each time (files, staged tables).

One row per (workspace_id, id) is kept: the one with the greatest
fingerprint, a choice that does not depend on scan order.  The aggregate is
partial on the map side, so a key repeated across a third of the input is
collapsed before the shuffle rather than landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEYS = ["workspace_id", "id"]


def dedupe_keys(df: DataFrame, keys: list[str] = KEYS, order_by: str | list[str] = "fingerprint",
                count_col: str | None = None) -> DataFrame:
    """Keep the row with the largest ``order_by`` per key (ties broken by the
    remaining columns), optionally with the number of copies per key."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("_best")
    aggs = [best] + ([F.count(F.lit(1)).alias(count_col)] if count_col else [])
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [*order, *rest]],
                      *([count_col] if count_col else []))


def dedupe_repeated(df: DataFrame, keys: list[str] = KEYS, order_by: str | list[str] = "fingerprint",
                    count_col: str | None = None) -> DataFrame:
    """As :func:`dedupe_keys`, without a sort of the rows whose key is unique.

    A hash aggregate counts the keys (narrow: nothing but key columns is read,
    and a key that holds a third of the rows collapses before the shuffle).
    The repeated ones are the small side of a hash join on the key, which
    tells their rows apart; only those are aggregated at full width, and rows of
    a null key, which no join meets and which are taken from ``df`` by
    themselves.  Both sides of the split then read the same rows, so one
    shuffle serves them; none is made where ``df`` is already dealt by the last
    key (``spread``).  ``df`` is evaluated more than once, so it must give the
    same rows each time.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    repeated = (df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1).withColumn("_n", F.lit(True)))
    same, whole = F.lit(True), F.lit(True)
    for k, n in zip(keys, names, strict=True):
        same, whole = same & (F.col(k) == F.col(n)), whole & F.col(k).isNotNull()
    rows = df.filter(whole).join(repeated.hint("shuffle_hash"), same, "left").drop(*names)
    unique = rows.filter(F.col("_n").isNull()).drop("_n")
    if count_col:
        unique = unique.withColumn(count_col, F.lit(1).cast("bigint"))
    for several in (rows.filter(F.col("_n").isNotNull()).drop("_n"), df.filter(~whole)):
        unique = unique.unionByName(dedupe_keys(several, keys, order_by, count_col))
    return unique
