"""Exact rendering, snapshot order and the recorded bucket count."""

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfsync.config import ColumnMapping, SyncConfig
from shelfsync.functions.js import js_number, js_string
from shelfsync.operators.embed import hashing_embedder
from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_sync
from shelfsync.sources.store import TableStore


def rendered(df, name, fn=js_string):
    return [r[0] for r in df.select(fn(F.col(name), df.schema[name].dataType)).collect()]


def test_decimals_floats(spark):
    df = spark.createDataFrame([(Decimal("9007199254740993.00"), 19.99), (Decimal("-0.50"), 2.0)], "d decimal(30,2), f float")
    assert rendered(df, "d") == ["9007199254740993", "-0.5"]
    assert rendered(df, "f") == ["19.99", "2"]
    assert rendered(df, "f", js_number) == [19.99, 2.0]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("select timestamp_micros(1700000000123456) t, timestamp_micros(-1000) u, timestamp_ntz'2024-01-02 03:04:05.5' n")
    want = [["2023-11-14T22:13:20.123456Z"], ["1969-12-31T23:59:59.999Z"], ["2024-01-02T03:04:05.500Z"]]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [rendered(df, c) for c in "tun"] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_reopened_with_another_bucket_count(spark, store_root):
    TableStore(spark, store_root, 4).read("state").count()
    with pytest.raises(ValueError, match="4 buckets"):
        TableStore(spark, store_root, 16).read("state")


def test_unchanged_newer_snapshot_blocks_an_older_one(spark, tmp_path):
    mapping = ColumnMapping(id="id", description="d", code="c", price="p")
    cfg = SyncConfig("11111111-1111-1111-1111-111111111111", mapping, mode="quick", order_by="ts")
    batches = [("A", 1), ("A", 5), ("B", 3)]
    for n, order in enumerate([(0, 1, 2), (1, 2, 0), (2, 0, 1)]):
        store = TableStore(spark, str(tmp_path / f"s{n}"), 2)
        for k, i in enumerate(order):
            src = spark.createDataFrame([("x", batches[i][0], "c", 1.0, batches[i][1])], "id string, d string, c string, p double, ts int")
            run_sync(spark, store, [Tenant(src, cfg)], embedder=FunctionEmbedder(hashing_embedder(8)),
                     as_of=dt.datetime(2024, 1, 1, 0, k))
        assert [r["description"] for r in store.read_products().collect()] == ["A"]
        assert [r["source_order"] for r in store.read("state").collect()] == [5]
