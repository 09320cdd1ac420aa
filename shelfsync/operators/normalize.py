"""Normalisation of processed rows into the canonical product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfsync.config import PROMO_WINDOW
from shelfsync.functions.js import is_falsy, js_number, js_or_empty
from shelfsync.functions.text import sanitize
from shelfsync.operators.detect import ts_literal
from shelfsync.schema import UPDATE_COLUMNS

_INT_LIMIT = float(2 ** 31)


def _role(df: DataFrame, role: str):
    name = f"_r_{role}"
    if name in df.columns:
        return F.col(name), df.schema[name].dataType
    return None, None


def minor_units(c: Column, dtype, exact_cents: bool = False) -> Column:
    """``Number(x) * 100`` in IEEE double (19.99 → 1998.9999999999998);
    ``exact_cents`` rounds to whole cents instead."""
    v = js_number(c, dtype) * F.lit(100.0)
    return F.round(v, 0) if exact_cents else v


def has_promo(promo: Column, price: Column) -> Column:
    """Promo is truthy (not null, 0 or NaN) and differs from the price.  JS
    treats NaN as unequal to itself, hence the NaN-price arm.  A promo above
    the price still counts."""
    return (F.coalesce(promo.isNotNull() & (promo != 0) & ~F.isnan(promo)
                       & (F.isnan(price) | (promo != price)), F.lit(False)))


def stock_value(c: Column | None, dtype) -> Column:
    """``Number(x) || 0`` as INT; NaN → 0.  A fractional stock is truncated and
    an out-of-range one becomes NULL — both are counted by the quality report,
    the latter by the run record too."""
    if c is None:
        return F.lit(0).cast("int")
    n = js_number(c, dtype)
    n = F.when(F.isnan(n), F.lit(0.0)).otherwise(n)
    return F.when(F.abs(n) < _INT_LIMIT, n.cast("int"))


def stock_lost(classified: DataFrame) -> Column:
    """Processed rows whose stock no INT holds (see :func:`stock_value`), as a count to observe."""
    c, dtype = _role(classified, "stock")
    if c is None:
        return F.lit(0).cast("bigint").alias("n_stock_lost")
    n = js_number(c, dtype)
    lost = F.col("id").isNotNull() & F.col("process") & ~F.isnan(n) & (F.abs(n) >= _INT_LIMIT)
    return F.sum(F.when(lost, 1).otherwise(0)).cast("bigint").alias("n_stock_lost")


def flag_value(c: Column | None, dtype) -> Column:
    """``x === 1``: strict, so the string '1' is false.  A boolean column is
    taken as the 0/1 number the source driver would have delivered."""
    if c is None:
        return F.lit(False)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c.cast("double") == 1, F.lit(False))
    return F.lit(False)


def normalize(df: DataFrame, as_of: dt.datetime, exact_cents: bool = False,
              keep: tuple[str, ...] = ("workspace_id", "id", "fingerprint", "status", "reason")) -> DataFrame:
    """Canonical product columns from the ``_r_<role>`` raw values.

    Promotion start/end are stamped with the run's ``as_of`` and
    ``as_of + 3650 days`` whenever a row carries a promotion.
    """
    price_c, price_t = _role(df, "price")
    promo_c, promo_t = _role(df, "promotion_price")
    desc_c, desc_t = _role(df, "description")
    disp_c, disp_t = _role(df, "display_name")
    code_c, code_t = _role(df, "code")
    manu_c, manu_t = _role(df, "manufactory")
    stock_c, stock_t = _role(df, "stock")
    flag_c, flag_t = _role(df, "need_prescription")

    price = minor_units(price_c, price_t, exact_cents)
    promo = minor_units(promo_c, promo_t, exact_cents) if promo_c is not None else F.lit(None).cast("double")
    kept = [c for c in keep if c in df.columns]
    step = df.select(
        *kept,
        sanitize(desc_c, desc_t).alias("description"),
        (sanitize(disp_c, disp_t) if disp_c is not None else F.lit(None).cast("string")).alias("_display"),
        js_or_empty(code_c, code_t).alias("code"),
        (js_or_empty(manu_c, manu_t) if manu_c is not None else F.lit("")).alias("manufactory"),
        price.alias("price"),
        promo.alias("_promo"),
        stock_value(stock_c, stock_t).alias("stock"),
        flag_value(flag_c, flag_t).alias("need_prescription"),
    )
    promo_on = has_promo(F.col("_promo"), F.col("price"))
    display = F.col("_display") if disp_c is not None else F.col("description")
    return step.select(
        *kept,
        "description",
        display.alias("display_name"),
        "code", "manufactory", "price",
        F.when(promo_on, F.col("_promo")).alias("promotion_price"),
        F.when(promo_on, ts_literal(as_of)).alias("promotion_start"),
        F.when(promo_on, ts_literal(as_of + PROMO_WINDOW)).alias("promotion_end"),
        "stock", "need_prescription",
    )


def embedding_text(df: DataFrame) -> Column:
    """Text sent to the embedder: display name, or the description when the
    display name is empty (a fallback on the value, unlike the display-name
    fallback, which is on the mapping)."""
    return F.when(F.col("display_name") != "", F.col("display_name")).otherwise(F.col("description"))


__all__ = ["normalize", "embedding_text", "minor_units", "has_promo", "stock_value",
           "flag_value", "UPDATE_COLUMNS", "is_falsy"]
