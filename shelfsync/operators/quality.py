"""Data-quality and catalog checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfsync.config import ColumnMapping
from shelfsync.functions.js import js_number
from shelfsync.functions.text import sanitize

# Fixed value: the UUID shape a workspace id must have (case-insensitive).
UUID_RE = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def uuid_from_md5(c: Column) -> Column:
    """8-4-4-4-12 grouping of md5(c): the workspace id rule of the fixtures."""
    return F.regexp_replace(F.md5(c), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")


def workspaces(nation: DataFrame) -> DataFrame:
    """The workspace dimension (id, name), listed by name."""
    return nation.select(uuid_from_md5(F.col("n_name")).alias("id"), F.col("n_name").alias("name")).orderBy("name")


def workspace_check(rows: DataFrame, dims: DataFrame) -> DataFrame:
    """Per workspace seen in ``rows``: row count, UUID shape, known to the
    dimension.  The join strategy is left to the planner and to run-time sizes."""
    seen = rows.groupBy("workspace_id").agg(F.count(F.lit(1)).alias("n_rows"))
    known = dims.select(F.col("id").alias("workspace_id"), F.lit(True).alias("_known")).distinct()
    return (seen.join(known, "workspace_id", "left")
            .select("workspace_id", "n_rows",
                    F.col("workspace_id").rlike(UUID_RE).alias("valid_uuid"),
                    F.coalesce(F.col("_known"), F.lit(False)).alias("known")))


def _n(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def dq_counts(source: DataFrame, mapping: ColumnMapping, workspace_id: str) -> DataFrame:
    """Row-level quality counts of one mapped source, in one aggregate pass
    plus one distinct-key count: null ids, duplicate keys, NaN prices,
    fractional or out-of-range stock, empty description after cleaning."""
    types = {f.name: f.dataType for f in source.schema.fields}
    idc = F.col(mapping.id)
    price = js_number(F.col(mapping.price), types[mapping.price])
    if mapping.stock:
        st = js_number(F.col(mapping.stock), types[mapping.stock])
        frac = ~F.isnan(st) & (st != F.floor(st).cast("double")) & (F.abs(st) < 2.0 ** 31)
        big = ~F.isnan(st) & (F.abs(st) >= 2.0 ** 31)
    else:
        frac = big = F.lit(False)
    desc = sanitize(F.col(mapping.description), types[mapping.description])
    keyed = source.select(idc.alias("_id"), price.alias("_price"), frac.alias("_frac"), big.alias("_big"),
                          desc.alias("_desc"))
    # Per key first (partial aggregation collapses hot keys map-side), then
    # one row over the keys.
    per_key = keyed.groupBy("_id").agg(
        F.count(F.lit(1)).alias("_n"), _n(F.isnan("_price")).alias("_nan"), _n(F.col("_frac")).alias("_fr"),
        _n(F.col("_big")).alias("_bg"), _n(F.col("_desc") == "").alias("_em"))
    has_id = F.col("_id").isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(F.when(~has_id, F.col("_n"))), F.lit(0)).cast("bigint").alias("null_ids"),
        F.coalesce(F.sum(F.when(has_id, F.col("_n") - 1)), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        _n(has_id & (F.col("_n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum("_nan"), F.lit(0)).cast("bigint").alias("nan_prices"),
        F.coalesce(F.sum("_fr"), F.lit(0)).cast("bigint").alias("fractional_stock"),
        F.coalesce(F.sum("_bg"), F.lit(0)).cast("bigint").alias("stock_out_of_range"),
        F.coalesce(F.sum("_em"), F.lit(0)).cast("bigint").alias("empty_descriptions"),
    ).select(F.lit(workspace_id).alias("workspace_id"), "*")


def source_profile(source: DataFrame, mapping: ColumnMapping) -> DataFrame:
    """One row per mapped role: source column, its ordinal position and type
    in the source, and how many values are non-null (one aggregate pass)."""
    ordinal = {f.name: i + 1 for i, f in enumerate(source.schema.fields)}
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    cols = mapping.source_columns()
    counts = source.agg(*[F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{role}', '{c}', {ordinal[c]}, '{types[c]}', _nn_{cols.index(c)}" for role, c in mapping.roles())
    return counts.selectExpr(f"stack({len(mapping.roles())}, {stack}) AS (role, column_name, ordinal_position, data_type, non_null)")
