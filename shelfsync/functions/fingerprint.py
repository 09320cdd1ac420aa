"""Row fingerprint: SHA-256 over the mapped values joined by a pipe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfsync.functions.js import render


def row_text(df: DataFrame, columns: list[str]) -> Column:
    """Values in mapping order, each rendered as JS prints it, joined by '|'.

    ``concat_ws`` skips NULLs, so every value is coalesced to '' first.
    Known collisions are kept on purpose: ("a|b","c") vs ("a","b|c"), and
    null vs ''.
    """
    return row_text_of(columns, {f.name: f.dataType for f in df.schema.fields})


def row_text_of(columns: list[str], types: dict) -> Column:
    """:func:`row_text` for columns of known types."""
    return F.concat_ws("|", *[render(F.col(c), types[c]) for c in columns])


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """Lowercase hex SHA-256 of :func:`row_text`."""
    return fingerprint_of(columns, {f.name: f.dataType for f in df.schema.fields})


def fingerprint_of(columns: list[str], types: dict) -> Column:
    """:func:`fingerprint` for columns of known types."""
    return F.sha2(row_text_of(columns, types), 256)
