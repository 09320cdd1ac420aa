"""Title enrichment for new rows.

The remote page fetch of a one-machine tool becomes a join: pages are
crawled once into a table keyed by product code, titles are extracted with
built-in regex functions, and new rows join that table.  A pluggable
client (``fetch_pages``) covers sources that can only be called.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfsync.functions.text import page_title

HTML_TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"


def pages_from_html(pages: DataFrame, code_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """Reader-style page text (``Title: …`` then ``URL Source: …``) from raw
    HTML, keyed by product code."""
    title = F.regexp_extract(F.col(html_col), HTML_TITLE_RE, 1)
    text = F.concat(F.lit("Title: "), title, F.lit("\nURL Source: "), F.coalesce(F.col(url_col), F.lit("")),
                    F.lit("\n"))
    return pages.select(F.col(code_col).cast("string").alias("code"), text.alias("page"))


def title_table(lookup: DataFrame) -> DataFrame:
    """(code, title) with one usable title per code.  Pages without a usable
    title are dropped; if a code has several, the smallest title wins."""
    t = lookup.select("code", page_title(F.col("page")).alias("title")).filter(F.col("title").isNotNull())
    return t.groupBy("code").agg(F.min("title").alias("title"))


def enrich_titles(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """Adds ``title`` and overrides ``display_name`` with it for *new* rows.

    Changed rows are not looked up and keep the source display name — so a
    looked-up title is lost at the row's first refresh, as in the original
    tool.  New and changed rows take separate branches so only new rows are
    shuffled for the join.
    """
    is_new = F.col("status") == "new"
    new = rows.filter(is_new).join(titles, "code", "left")
    new = new.withColumn("display_name", F.when(F.col("title").isNotNull() & (F.col("title") != ""),
                                                F.col("title")).otherwise(F.col("display_name")))
    rest = rows.filter(~is_new).withColumn("title", F.lit(None).cast("string"))
    return new.unionByName(rest)


def no_titles(rows: DataFrame) -> DataFrame:
    """Enrichment disabled: same schema, no lookups."""
    return rows.withColumn("title", F.lit(None).cast("string"))


class PageTitles:
    """Title lookup in a table of crawled pages (``code``, ``page``): pages
    are cut to the wanted codes before titles are extracted from them."""

    def __init__(self, pages: DataFrame):
        self.pages = pages

    def for_codes(self, codes: DataFrame, concurrency: int) -> DataFrame:
        return title_table(self.pages.join(codes.distinct(), "code", "left_semi"))


class ClientTitles:
    """Title lookup through a page client, called once per distinct code."""

    def __init__(self, fetch: Callable[[str], str | None]):
        self.fetch = fetch

    def for_codes(self, codes: DataFrame, concurrency: int) -> DataFrame:
        return title_table(fetch_pages(codes, self.fetch, concurrency))


def look_up_titles(rows: DataFrame, titles, off: list[str] = (), concurrency: int = 5) -> DataFrame:
    """:func:`enrich_titles` for all workspaces but those switched ``off``.
    ``titles`` is a ``(code, title)`` table, a lookup like
    :class:`PageTitles` or :class:`ClientTitles`, or None (no lookups)."""
    if titles is None:
        return no_titles(rows)
    on = rows.filter(~F.col("workspace_id").isin(list(off))) if off else rows
    if not isinstance(titles, DataFrame):
        titles = titles.for_codes(on.filter(F.col("status") == "new").select("code"), concurrency)
    done = enrich_titles(on, titles)
    return done.unionByName(no_titles(rows.filter(F.col("workspace_id").isin(list(off))))) if off else done


def map_with_client(values: DataFrame, col: str, fn: Callable, out_col: str,
                    concurrency: int = 5, out_type: str = "string") -> DataFrame:
    """Call ``fn(value)`` once per distinct value with at most ``concurrency``
    calls in flight (one per partition); a raising call yields NULL.  Result
    rows keep their input value, so order does not matter."""
    def run(batches):
        for pdf in batches:
            out = []
            for v in pdf[col]:
                try:
                    out.append(fn(v))
                except Exception:  # a failed call is a missing value, never a failed run
                    out.append(None)
            yield pd.DataFrame({col: pdf[col], out_col: out})

    distinct = values.select(col).filter(F.col(col).isNotNull()).distinct().repartition(concurrency)
    return distinct.mapInPandas(run, f"{col} string, {out_col} {out_type}")


def fetch_pages(codes: DataFrame, fetch: Callable[[str], str | None], concurrency: int = 5) -> DataFrame:
    """(code, page) from a user-supplied page client, for :func:`title_table`."""
    return map_with_client(codes, "code", fetch, "page", concurrency)
