"""Tenants and prior state derived by Spark from the driver's tables.

The driver ships TPC-H-like tables; these functions read them through column
mappings so that every registered query runs over whole tables.  Nothing
here is sampled: derived columns are pure functions of each row.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsync.config import ColumnMapping
from shelfsync.operators.detect import ts_literal

# Fixed instant used by every registered query, so results replay exactly.
AS_OF = dt.datetime(2024, 1, 1, 0, 0, 0)
STALE_MINUTES = 60


def workspace_uuid(name: str) -> str:
    """UUID-shaped id built from md5(name) (the workspace dimension's rule)."""
    h = hashlib.md5(name.encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


WS_PART = workspace_uuid("NATION_1")
WS_SUPPLIER = workspace_uuid("NATION_2")
WS_CUSTOMER = workspace_uuid("NATION_3")

# Tenant 1: parts.  The part key doubles as the barcode (one column mapped to
# two roles is read and hashed once); promotion and prescription columns are
# derived per row.
PART_MAPPING = ColumnMapping(id="p_partkey", description="p_name", code="p_partkey",
                             price="p_retailprice", manufactory="p_brand", stock="p_size",
                             promotion_price="p_promo", need_prescription="p_rx")
# Tenants 2 and 3: suppliers and customers, the four required roles only.
SUPPLIER_MAPPING = ColumnMapping(id="s_suppkey", description="s_name", code="s_name",
                                 price="s_acctbal")
CUSTOMER_MAPPING = ColumnMapping(id="c_custkey", description="c_name", code="c_name",
                                 price="c_acctbal")
# A text-typed source over parts, for the JavaScript coercion rules.
TEXT_MAPPING = ColumnMapping(id="t_id", description="t_desc", code="t_code", price="t_price",
                             display_name="t_display", manufactory="t_manu", stock="t_stock",
                             promotion_price="t_promo", need_prescription="t_rx")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 6
    promo = (F.when(k == 0, F.lit(None).cast("double"))
             .when(k == 1, F.col("p_retailprice"))
             .when(k == 2, F.lit(0.0))
             .when(k == 3, F.col("p_retailprice") - 100)
             .when(k == 4, F.col("p_retailprice") + 10)
             .otherwise(F.col("p_retailprice") * 0.5))
    return p.withColumn("p_promo", promo).withColumn("p_rx", (F.col("p_size") % 3).cast("int"))


def text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts re-typed as text the way a loosely typed source delivers them:
    padded numbers, empty strings, junk, NULLs."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price_s = F.col("p_retailprice").cast("string")
    m7 = k % 7
    price = (F.when(m7 == 0, F.lit(None).cast("string")).when(m7 == 1, F.lit(""))
             .when(m7 == 2, F.lit("abc")).when(m7 == 3, F.concat(F.lit(" "), price_s, F.lit("\t")))
             .when(m7 == 4, F.concat(price_s, F.lit("e0"))).otherwise(price_s))
    m5 = k % 5
    promo = (F.when(m5 == 0, F.lit(None).cast("string")).when(m5 == 1, price_s)
             .when(m5 == 2, F.lit("0")).when(m5 == 3, F.lit("12.5")).otherwise(F.lit("x1")))
    m4 = k % 4
    stock = (F.when(m4 == 0, F.col("p_size").cast("string")).when(m4 == 1, F.lit("abc"))
             .when(m4 == 2, F.lit(None).cast("string")).otherwise(F.lit("2.75")))
    code = F.when(k % 3 == 0, F.lit(0).cast("bigint")).otherwise(k * 1000 + 7)
    rx = F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit(None).cast("string"))
    display = F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.col("p_brand"), F.lit(" – "), F.col("p_name")))
    manu = F.when(k % 3 == 1, F.lit("")).otherwise(F.col("p_brand"))
    return p.select(k.cast("string").alias("t_id"), F.col("p_name").alias("t_desc"), code.alias("t_code"),
                    price.alias("t_price"), display.alias("t_display"), manu.alias("t_manu"),
                    stock.alias("t_stock"), promo.alias("t_promo"), rx.alias("t_rx"))


def prior_state(keyed: DataFrame, as_of: dt.datetime = AS_OF) -> DataFrame:
    """State as a previous run would have left it, derived from the keyed
    source: keys with ``key % 5 <> 0`` are known; the stored fingerprint is
    stale ('x') where ``key % 7 = 0``; the age is ``(key*13) % 120`` minutes."""
    k = F.col("id").cast("bigint")
    age = F.make_dt_interval(F.lit(0), F.lit(0), ((k * 13) % 120).cast("int"))
    return keyed.filter(k % 5 != 0).select(
        "workspace_id", "id",
        F.when(k % 7 == 0, F.lit("x")).otherwise(F.col("fingerprint")).alias("fingerprint"),
        (ts_literal(as_of) - age).alias("updated_at"))


WS_TEXT = workspace_uuid("NATION_4")
WS_LINEITEM = workspace_uuid("LINEITEM")   # UUID-shaped but absent from the dimension

# Order lines as a product source: (part, supplier) is the key, and it
# repeats across orders — the duplicate-key case.
LINEITEM_MAPPING = ColumnMapping(id="li_key", description="li_desc", code="l_orderkey",
                                 price="l_extendedprice", stock="l_quantity")


def lineitem_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    desc = F.concat(F.lit("Line "), F.col("l_linenumber").cast("string"), F.lit(" "),
                    F.col("l_returnflag"), F.col("l_linestatus"))
    return li.withColumn("li_key", key).withColumn("li_desc", desc)


def prior_target(keyed: DataFrame, as_of: dt.datetime = AS_OF) -> DataFrame:
    """Target rows a previous run would have written: known keys except
    ``key % 3 = 0`` (those become orphan updates), with an older price, a
    promotion that updates must clear, and a one-element vector."""
    from shelfsync.operators.normalize import normalize

    k = F.col("id").cast("bigint")
    base = keyed.filter((k % 5 != 0) & (k % 3 != 0))
    return (normalize(base, as_of, keep=("workspace_id", "id"))
            .withColumn("price", F.col("price") - 1)
            .withColumn("promotion_price", F.lit(1.0))
            .withColumn("embedding", F.array(F.col("id").cast("bigint").cast("float"))))


WS_EVENTS = workspace_uuid("NATION_5")
# Events as a snapshot stream: a user's latest event is its current product.
EVENTS_MAPPING = ColumnMapping(id="user_id", description="event_type", code="event_type", price="value")
EVENTS_ORDER = "ts"
