"""JavaScript value semantics expressed as Spark column expressions.

The source rows of a sync are plain values whose meaning is fixed by
JavaScript's coercion rules (number parsing, falsiness, string rendering).
Each helper takes the column and its Spark data type, decided at plan time.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# JavaScript's whitespace set (what ``\s`` and ``trim`` accept),
# written as a regex character-class body valid in Java regex and RE2: the
# ASCII part, then the wider Unicode spaces.
JS_WS_WIDE = r"\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
JS_WS = r"\t\n\x0B\f\r " + JS_WS_WIDE

# Fixed value: decimal literals that ``Number(string)`` accepts once trimmed.
# Hex/octal/binary prefixes are left unparsed (NaN) on purpose.
JS_NUMBER_RE = r"^[+-]?(Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)$"

_TWO_53 = float(2 ** 53)


def _is_string(dtype) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def _is_float(dtype) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType))


def js_trim(c: Column) -> Column:
    """``String.prototype.trim``: strips the whole JS whitespace set."""
    return F.regexp_replace(c, f"^[{JS_WS}]+|[{JS_WS}]+$", "")


def js_number(c: Column, dtype) -> Column:
    """``Number(x)`` as DOUBLE: null → 0, '' → 0, unparsable → NaN."""
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))  # null → 0 as well
    if isinstance(dtype, T.FloatType):  # the number its text says, not its widened bits
        return F.coalesce(c.cast("string").cast("double"), F.lit(0.0))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c.cast("double"), F.lit(0.0))
    if _is_string(dtype):
        t = js_trim(c)
        return (F.when(c.isNull() | (t == ""), F.lit(0.0))
                .when(t.rlike(JS_NUMBER_RE), t.try_cast("double"))
                .otherwise(F.lit(float("nan"))))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(_epoch_micros(c, dtype).cast("double") / 1000.0, F.lit(0.0))
    if isinstance(dtype, T.DateType):
        return F.coalesce(F.unix_date(c).cast("double") * 86400000.0, F.lit(0.0))
    return F.when(c.isNull(), F.lit(0.0)).otherwise(F.lit(float("nan")))


def is_falsy(c: Column, dtype) -> Column:
    """JS falsiness, never NULL: null, '', 0, NaN and false are falsy."""
    if _is_string(dtype):
        cond = c.isNull() | (c == "")
    elif _is_float(dtype):
        d = c.cast("double")
        cond = c.isNull() | (d == 0) | F.isnan(d)
    elif isinstance(dtype, T.NumericType):
        cond = c.isNull() | (c == 0)
    elif isinstance(dtype, T.BooleanType):
        cond = c.isNull() | ~c
    else:
        cond = c.isNull()
    return F.coalesce(cond, F.lit(True))


def _render_double(d: Column) -> Column:
    return (F.when(F.isnan(d), F.lit("NaN"))
            .when(d == float("inf"), F.lit("Infinity"))
            .when(d == float("-inf"), F.lit("-Infinity"))
            .when((F.abs(d) < _TWO_53) & (F.rint(d) == d), d.cast("bigint").cast("string"))
            .otherwise(d.cast("string")))


def _epoch_micros(c: Column, dtype) -> Column:
    """Microseconds since the epoch in UTC, whatever the session time zone (a
    zoneless timestamp is read as UTC)."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_micros(c)


def _render_timestamp(micros: Column) -> Column:
    """ISO text in UTC; microseconds are printed where there are any, so two
    different instants never print alike."""
    day = F.lit(86_400_000_000).cast("bigint")
    rest = F.pmod(micros, day)
    date = F.date_format(F.date_from_unix_date(((micros - rest) / day).cast("int")), "yyyy-MM-dd")

    def two(part: Column, width: int = 2) -> Column:
        return F.lpad(F.floor(part).cast("string"), width, "0")

    frac = F.when(micros % 1000 == 0, two(rest % 1_000_000 / 1000, 3)).otherwise(two(rest % 1_000_000, 6))
    return F.concat(date, F.lit("T"), two(rest / 3_600_000_000), F.lit(":"), two(rest / 60_000_000 % 60), F.lit(":"),
                    two(rest / 1_000_000 % 60), F.lit("."), frac, F.lit("Z"))


def _render_decimal(c: Column) -> Column:
    """Exact digits without trailing zeros: ids beyond 2^53 stay distinct."""
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def js_string(c: Column, dtype) -> Column:
    """``String(x)`` for a non-null value.  Integral doubles print without
    ``.0``, decimals exactly, floats by their own digits; booleans print as
    1/0 because the source driver hands TINYINT(1) flags over as numbers;
    timestamps print in ISO form, in UTC."""
    if _is_string(dtype):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("1")).when(~c, F.lit("0"))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("string")
    if isinstance(dtype, T.DecimalType):
        return _render_decimal(c)
    if isinstance(dtype, T.FloatType):
        return _render_double(c.cast("string").cast("double"))
    if _is_float(dtype):
        return _render_double(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _render_timestamp(_epoch_micros(c, dtype))
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(c))
    return c.cast("string")


def render(c: Column, dtype) -> Column:
    """How ``Array.prototype.join`` prints one value: null → ''."""
    return F.coalesce(js_string(c, dtype), F.lit(""))


def js_or_empty(c: Column, dtype) -> Column:
    """``String(x || "")``."""
    return F.when(is_falsy(c, dtype), F.lit("")).otherwise(js_string(c, dtype))
