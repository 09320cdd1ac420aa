"""Mixing sources to target weights, with DataFrame functions only.

Tokens are summed per source, a target is set for each source, and the
repetition rate is target / size.  A document is taken floor(rate) times plus
one hash-seeded Bernoulli copy whose probability is the rate's fraction.

Targets share the corpus size by weight, but stop at ``cap`` times a source's
size; the excess is shared again by weight until none is above.  The fixed
point of that resharing is a water level: with sources ordered by
cap * size / weight, the capped ones are a prefix of that order.

Scale: the sums pre-aggregate before the shuffle, so a source holding a third
of the rows is no hot group.  The plan of targets has one row per source.  It
is written out, so its size is known when documents are joined with it: the
planner broadcasts it below the session's broadcast limit and otherwise
shuffles (a skewed source is then split by the adaptive skew join).

Edge cases: null or empty text has size 0; a null source is a source of its
own, last in order; a source of size 0 has target 0 and its documents are
emitted once; rows sharing a doc_id share the draw; rows with a null doc_id
draw by their text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from shelfsync.llm.common import stage, word_count

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 17


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    ``weights`` repeat along the sources in code point order, null last.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                          (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = per.withColumn("w", weight).withColumn("capped", F.col("source_size") * F.lit(cap).cast("long"))
    level = W.orderBy(F.col("capped") / F.col("w"), F.col("source").asc_nulls_last())
    upto = level.rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    run = ranked.select("source", "source_size", "w", "capped",
                        F.sum("source_size").over(everything).alias("all_size"),
                        F.sum("w").over(everything).alias("all_w"),
                        (F.sum("capped").over(upto) - F.col("capped")).alias("capped_before"),
                        (F.sum("w").over(upto) - F.col("w")).alias("w_before"))
    full = F.col("capped") * (F.col("all_w") - F.col("w_before")) <= \
        (F.col("all_size") - F.col("capped_before")) * F.col("w")
    marked = run.withColumn("full", full)
    totals = marked.select(
        "source", "source_size", "w", "capped", "full",
        (F.col("all_size") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capped"))).over(everything),
                                        F.lit(0))).alias("rest"),
        (F.col("all_w") - F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(everything),
                                     F.lit(0))).alias("rest_w"))
    target = F.when(F.col("full"), F.col("capped").cast("double")).otherwise(
        F.col("rest").cast("double") * F.col("w").cast("double") / F.col("rest_w").cast("double"))
    return totals.select("source", "source_size", target.alias("target"))


def unit_draw(doc_id, text, seed: int):
    """A draw in [0, 1) fixed by the seed and the document's id (its text if the id is null)."""
    who = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), who)), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    copies, taken`` and the columns named in ``carry``.

    ``docs`` needs ``doc_id, text, source``; its other columns are ignored
    unless carried, so their names cannot clash.
    """
    sized = docs.select("doc_id", "text", "source", word_count(F.col("text")).alias("size"))
    plan = stage(source_targets(sized.select("source", "size"), weights, cap), "mixing-targets")
    plan = plan.select(F.col("source").alias("plan_source"), "source_size", "target")
    keep = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       unit_draw("doc_id", "text", seed).alias("draw"), *keep)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    copies = F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("long")
    out = (base.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
           .withColumn("rate", rate).withColumn("copies", copies))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"),
                      *[F.col(f"carry_{i}").alias(f"carry_{i}") for i in range(len(carry))])


def emit(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document of ``docs`` repeated ``copies`` times, with its own columns."""
    cols = docs.columns
    planned = mix(docs, weights, cap, seed, carry=tuple(cols))
    taken = planned.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*[F.col(f"carry_{i}").alias(c) for i, c in enumerate(cols)])


#: DuckDB SQL for :func:`mix` over ``documents`` with the default parameters.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, text, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
ranked AS (SELECT source, source_size,
                  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS w
           FROM per),
run AS (
  SELECT source, source_size, w, 3 * source_size AS capped,
         sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w,
         sum(3 * source_size) OVER lv - 3 * source_size AS capped_before, sum(w) OVER lv - w AS w_before
  FROM ranked
  WINDOW lv AS (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
marked AS (SELECT *, capped * (all_w - w_before) <= (all_size - capped_before) * w AS is_full FROM run),
totals AS (
  SELECT *, all_size - coalesce(sum(CASE WHEN is_full THEN capped END) OVER (), 0) AS rest,
         all_w - coalesce(sum(CASE WHEN is_full THEN w END) OVER (), 0) AS rest_w FROM marked),
plan AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN capped::DOUBLE ELSE rest::DOUBLE * w::DOUBLE / rest_w::DOUBLE END AS target FROM totals),
rated AS (
  SELECT d.doc_id, d.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN p.target / p.source_size::DOUBLE ELSE 1.0 END AS rate,
         ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, 't' || md5(coalesce(d.text, '')))), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
