"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``SPAN`` consecutive words of a benchmark item, or a whole shorter
item.  For windows of n words, k-grams of k = n // 2 + 1 words are hashed and
of every n - k + 1 neighbouring hashes (the k-grams of one window) the smallest
is kept: the window's fingerprint.  Equal windows have equal fingerprints, so
joining the fingerprints of documents and items meets every shared window for
certain.  Neighbouring windows mostly share their fingerprint, so a document
sends one row for each run of windows with the same one.  Each joined run is
then extended to its windows, and those are compared word by word with the
benchmark's; only equal words count.

Scale: a document's arrays stay within its row; what leaves it is its text's
digest and one number a run.  The benchmark's fingerprints, and the runs that
met one, are broadcast when their size, checked first, is bounded
(``BROADCAST_ROWS``, ``BROADCAST_BYTES``); beyond that the same joins are
shuffled.  Documents of equal text are one digest, so thousands of copies
collapse before the shuffle; texts themselves are shuffled only where the runs
that met a fingerprint are too many to broadcast.

Edge cases: a null or empty text, and one without words, has no words and no
hits; a benchmark item without words or with a null item_id takes no part;
rows that share an item_id are one item; rows that share a doc_id are
different documents, each returned; an empty benchmark leaves every document
clean; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfsync.llm.common import stage

#: Words of a window.
SPAN = 10
#: Fixed value: what lies between words (all of ASCII but letters and digits).
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What may be broadcast at most: rows of (fingerprint), bytes of (digest, runs).
BROADCAST_ROWS, BROADCAST_BYTES = 1 << 19, 16 << 20


def _words(text: str) -> Column:
    """The words of a text in their own case.  Splitting is about ten times as fast as extracting matches."""
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN), "")


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _gram_hashes(hashes: str, n: int) -> Column:
    """The hash of each k-gram that windows of ``n`` words hold."""
    k = n // 2 + 1
    grams = F.slice(F.col(hashes), F.lit(1), F.greatest(F.size(hashes) - (k - 1), F.lit(0)))
    return F.transform(grams, lambda x, i: F.xxhash64(x, *[F.get(F.col(hashes), i + j) for j in range(1, k)]))


def _window_minima(grams: str, n: int) -> Column:
    """The smallest of each n - k + 1 neighbouring hashes: one for each window of ``n`` words."""
    w = n - n // 2
    first = F.slice(F.col(grams), F.lit(1), F.greatest(F.size(grams) - (w - 1), F.lit(0)))
    if w == 1:
        return first
    return F.transform(first, lambda x, i: F.least(x, *[F.get(F.col(grams), i + j) for j in range(1, w)]))


def _run_starts(minima: str) -> Column:
    """The places where a new minimum begins."""
    m = F.col(minima)
    return F.filter(F.transform(m, lambda x, i: F.when((i == 0) | (x != F.get(m, i - 1)), i)), lambda i: i.isNotNull())


def _runs(minima: str, starts: str, n: int) -> Column:
    m, s = F.col(minima), F.col(starts)
    return F.transform(s, lambda a, j: F.struct(a.alias("first"), F.coalesce(F.get(s, j + 1), F.size(m)).alias("past"),
                                                F.lit(n).alias("span"), F.get(m, a).alias("fp")))


def fingerprints(rows: DataFrame, keys: list[str], words: str, lengths: list[int]) -> DataFrame:
    """``keys, first, past, span, fp``: each run of windows of ``span`` words
    (the first window's place, the place past the last) with one fingerprint."""
    # The hash folds all cases, which may only let more windows meet: the words decide later.
    rows = rows.select(*keys, F.transform(words, lambda x: F.xxhash64(F.lower(x))).alias("_h"))
    for n in lengths:
        rows = rows.withColumn(f"_g{n}", _gram_hashes("_h", n))
    rows = rows.select(*keys, *[_window_minima(f"_g{n}", n).alias(f"_m{n}") for n in lengths])
    rows = rows.select(*keys, *[f"_m{n}" for n in lengths], *[_run_starts(f"_m{n}").alias(f"_s{n}") for n in lengths])
    runs = [_runs(f"_m{n}", f"_s{n}", n) for n in lengths]
    return rows.select(*keys, F.inline(F.concat(*runs)))


def windows(words: Column, first: Column, past: Column, span: Column) -> Column:
    """Each window of a run: its place, length and words joined by a space."""
    return F.transform(F.sequence(first, past - 1), lambda i: F.struct(
        i.alias("at"), span.alias("span"), _lower(F.array_join(F.slice(words, i + 1, span), " ")).alias("window")))


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``item, span, window``: the distinct windows of each item."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), _words("text").alias("_w"))
             .filter(F.col("item").isNotNull() & (F.size("_w") > 0)))
    n = F.least(F.size("_w"), F.lit(span))
    each = windows(F.col("_w"), F.lit(0), F.size("_w") - n + 1, n)
    return items.select("item", F.inline(each)).select("item", "span", "window").distinct()


def _bounded(df: DataFrame, size: Column, most: int) -> DataFrame:
    """``df`` (a staged table) hinted to be broadcast where its size is at most ``most``."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(df) if total <= most else df


def hits(documents: DataFrame, bench: DataFrame, span: int = SPAN) -> DataFrame:
    """``digest, at, span, window``: each benchmark window in each distinct
    document text (by the SHA-256 of the text), with the place of its first word.
    ``documents`` has ``digest`` and ``text``; ``bench`` is a staged :func:`benchmark_windows`."""
    lengths = [r["span"] for r in bench.select("span").distinct().orderBy("span").collect()]  # at most ``span`` numbers
    if not lengths:
        return bench.select(F.lit(b"").alias("digest"), F.lit(0).alias("at"), "span", "window").filter(F.lit(False))
    distinct = bench.select("span", "window").distinct()
    known = stage(fingerprints(distinct.select(F.split("window", " ").alias("_w"), F.col("span").alias("_n")),
                               ["_n"], "_w", lengths)
                  .filter(F.col("span") == F.col("_n")).select("fp", "span").distinct(), "winnow-fingerprints")
    runs = fingerprints(documents.select("digest", _words("text").alias("_w")), ["digest"], "_w", lengths)
    met = (runs.join(_bounded(known, F.lit(1), BROADCAST_ROWS), ["fp", "span"])
           .groupBy("digest").agg(F.collect_set(F.struct("first", "past", "span")).alias("runs")))
    met = stage(met, "winnow-runs")
    near = documents.join(_bounded(met, 64 + 24 * F.size("runs"), BROADCAST_BYTES), "digest")
    near = near.select("digest", "runs", _words("text").alias("_w"))
    each = F.flatten(F.transform("runs", lambda r: windows(F.col("_w"), r["first"], r["past"], r["span"])))
    found = near.select("digest", F.inline(each))
    return found.join(_bounded(distinct, F.lit(1), BROADCAST_ROWS // 4), ["span", "window"]).distinct()


def covered_words(found: DataFrame) -> DataFrame:
    """``digest, n_hit``: words that lie in some window; windows overlap, so
    each counts the words past the furthest end before it."""
    before = W.partitionBy("digest").orderBy("at", "span").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("at") + F.col("span")
    fresh = F.greatest(end - F.greatest(F.col("at"), F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    return (found.select("digest", "at", "span").distinct().withColumn("_n", fresh)
            .groupBy("digest").agg(F.sum("_n").cast("long").alias("n_hit")))


def decontaminate(documents: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = documents.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), "text")
    bench = stage(benchmark_windows(benchmark, span), "winnow-windows")
    found = stage(hits(docs.select("digest", "text"), bench, span), "winnow-hits")
    items = (found.select("digest", "window").distinct().join(bench.select("item", "window"), "window")
             .groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("_items")))
    result = covered_words(found).join(items, "digest")
    out = (docs.select("doc_id", "digest", F.size(_words("text")).cast("long").alias("n_words"))
           .join(result, "digest", "left"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("_items", ","), F.lit("")), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


_WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), '" + string.ascii_uppercase + "', '" + string.ascii_lowercase
              + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: The same rows in DuckDB's SQL: every window of every document compared.
DECONTAMINATE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM {{docs}}),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(len(w), {SPAN}) AS n
      FROM (SELECT item_id, {_WORDS_SQL} AS w FROM {{bench}} WHERE item_id IS NOT NULL) WHERE len(w) > 0),
bi AS (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bi),
di AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b)),
h AS (SELECT rid, di.n, i, item FROM di JOIN bw ON di.n = bw.n AND array_to_string(w[i:i + di.n - 1], ' ') = bw.win),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
       FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""
