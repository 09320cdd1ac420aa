"""Text cleaning: the product-text sanitiser and page-title extraction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfsync.functions.js import JS_WS, JS_WS_WIDE, is_falsy, js_string, js_trim

# The title-page patterns.  A title follows "Title:" plus one
# whitespace at the start of a line; titles reporting a missing product or a
# refused request are rejected; an "EAN <digits>" prefix and the site-name
# suffix (with an adjacent dash) are removed, then every remaining dash.
DASHES = "-–—"
TITLE_LINE_RE = f"(?m)^Title:[{JS_WS}]([^\\n]+)"
TITLE_REJECT_RE = "(?i)Product Not Found|Access denied"
TITLE_NOISE_RE = f"(?i)(EAN[{JS_WS}]*\\d+[{JS_WS}]*[{DASHES}]?[{JS_WS}]*|[{DASHES}]?[{JS_WS}]*Go-UPC[{JS_WS}]*)"
TITLE_DASH_RE = f"[{DASHES}]"

# The sanitiser's two classes in Java regex form (Spark runs java.util.regex).
# Without the UNICODE_CHARACTER_CLASS flag ``\p{Alnum}`` is exactly
# [a-zA-Z0-9] and ``\s`` exactly [ \t\n\x0B\f\r], so these are the same sets
# as ``[^a-zA-Z0-9<JS_WS>]`` and ``[<JS_WS>]``.  Written as intersections led
# by ``\P{Alnum}``, a letter — most characters of any text — is rejected by
# its first test; the plain union tests every member for every character and
# ran about 5x slower on long documents.
SANITIZE_DROP_RE = rf"[\P{{Alnum}}&&\S&&[^{JS_WS_WIDE}]]+"
SANITIZE_SPACE_RE = rf"[\P{{Alnum}}&&[\s{JS_WS_WIDE}]]+"


def sanitize(c: Column, dtype=None) -> Column:
    """Keep ASCII letters, digits and whitespace; collapse whitespace; trim.

    No Unicode normalisation happens first, so a precomposed accented letter
    is deleted while a decomposed one keeps its base letter.  Null → ''.
    """
    from pyspark.sql import types as T

    if dtype is None or isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        text = F.coalesce(c, F.lit(""))
    else:
        text = F.when(is_falsy(c, dtype), F.lit("")).otherwise(js_string(c, dtype))
    kept = F.regexp_replace(text, SANITIZE_DROP_RE, "")
    return F.trim(F.regexp_replace(kept, SANITIZE_SPACE_RE, " "))


def extract_title(page: Column) -> Column:
    """First "Title:" line of a page, trimmed; NULL when absent."""
    raw = F.regexp_extract(page, TITLE_LINE_RE, 1)
    return F.when(raw != "", js_trim(raw))


def clean_title(title: Column) -> Column:
    """Reject not-found / denied titles, strip barcode and site noise and all
    dashes.  An emptied title counts as not found (NULL)."""
    stripped = js_trim(F.regexp_replace(F.regexp_replace(title, TITLE_NOISE_RE, ""), TITLE_DASH_RE, ""))
    return F.when(~title.rlike(TITLE_REJECT_RE) & (stripped != ""), stripped)


def page_title(page: Column) -> Column:
    """Looked-up title of one page text: extraction then cleaning."""
    return clean_title(extract_title(page))
