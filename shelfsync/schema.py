"""Fixed schemas: canonical product, state, run log."""

from pyspark.sql import types as T

KEYS = ["workspace_id", "id"]

# Columns a data-only update rewrites (the embedding is kept).
UPDATE_COLUMNS = ["description", "display_name", "code", "manufactory", "price",
                  "promotion_price", "promotion_start", "promotion_end", "stock",
                  "need_prescription"]

PRODUCT_COLUMNS = KEYS + UPDATE_COLUMNS + ["embedding"]

PRODUCT = T.StructType([
    T.StructField("workspace_id", T.StringType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("manufactory", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("promotion_price", T.DoubleType()),
    T.StructField("promotion_start", T.TimestampNTZType()),
    T.StructField("promotion_end", T.TimestampNTZType()),
    T.StructField("stock", T.IntegerType()),
    T.StructField("need_prescription", T.BooleanType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

STATE = T.StructType([
    T.StructField("workspace_id", T.StringType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    # order value of the snapshot last applied (NULL when unordered)
    T.StructField("source_order", T.LongType()),
])

_RUN_FIELDS = [
    ("run_id", T.StringType()), ("batch_id", T.LongType()), ("stream_id", T.StringType()),
    ("as_of", T.TimestampNTZType()), ("modes", T.StringType()), ("workspaces", T.StringType()),
    *[(n, T.LongType()) for n in ("total", "n_rejected", "n_duplicates", "n_stock_lost", "to_process", "skipped", "n_new", "n_changed", "n_hash",
                                  "n_stale", "lookups_found", "with_embedding", "data_only",
                                  "embed_failed", "orphans", "processed")],
    ("duration_s", T.DoubleType()),
]
_TENANT = T.StructType([T.StructField("workspace_id", T.StringType()), T.StructField("mode", T.StringType())])
RUNS = T.StructType([*(T.StructField(n, t) for n, t in _RUN_FIELDS), T.StructField("tenants", T.ArrayType(_TENANT))])
