"""Classification per mode (FIXTURES §2) and golden counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfsync.operators import detect
from shelfsync.plans import fixtures as fx
from shelfsync.sources.scan import keyed_source

from conftest import SF01

AS_OF = dt.datetime(2024, 1, 1, 12, 0, 0)

# id, known, same hash, age in minutes
CASES = [("a", False, None, None), ("b", True, False, 10), ("c", True, True, 10),
         ("d", True, True, 60), ("e", True, True, 90)]
EXPECT = {  # id -> (quick, full, force) processed?
    "a": (True, True, True), "b": (True, True, True), "c": (False, False, True),
    "d": (True, False, True), "e": (True, False, True)}


@pytest.fixture()
def inputs(spark):
    keyed = spark.createDataFrame([("ws", i, f"h{i}") for i, *_ in CASES], "workspace_id string, id string, fingerprint string")
    rows = [("ws", i, f"h{i}" if same else "other", AS_OF - dt.timedelta(minutes=age))
            for i, known, same, age in CASES if known]
    state = spark.createDataFrame(rows, "workspace_id string, id string, fingerprint string, updated_at timestamp_ntz")
    return keyed, state


@pytest.mark.parametrize("mode,col", [("quick", 0), ("full", 1), ("force", 2)])
def test_mode_table(spark, inputs, mode, col):
    keyed, state = inputs
    got = {r.id: (r.process, r.status) for r in detect.classify(keyed, state, mode, AS_OF, 60).collect()}
    for i, known, *_ in CASES:
        assert got[i][0] == EXPECT[i][col], (mode, i)
        assert got[i][1] == ("changed" if known else "new")


def test_unknown_mode_raises(spark, inputs):
    with pytest.raises(ValueError):
        detect.classify(*inputs, "weekly", AS_OF, 60)


def test_quick_superset_of_full(spark):
    keyed = keyed_source(fx.part_source(spark, SF01), fx.PART_MAPPING, fx.WS_PART)
    state = fx.prior_state(keyed)
    q = detect.to_process(detect.classify(keyed, state, "quick", fx.AS_OF)).select("id")
    f = detect.to_process(detect.classify(keyed, state, "full", fx.AS_OF)).select("id")
    assert f.subtract(q).count() == 0


def test_golden_counts_sf001(spark):
    keyed = keyed_source(fx.part_source(spark, SF01), fx.PART_MAPPING, fx.WS_PART)
    state = fx.prior_state(keyed)
    cls = detect.classify(keyed, state, "quick", fx.AS_OF)
    row = cls.agg(F.count(F.lit(1)).alias("total"),
                  F.sum((F.col("status") == "new").cast("int")).alias("new"),
                  F.sum((F.col("reason") == "hash").cast("int")).alias("hash"),
                  F.sum((F.col("reason") == "stale").cast("int")).alias("stale"),
                  F.sum((~F.col("process")).cast("int")).alias("skipped")).first()
    assert (row.total, row.new, row.hash, row.stale, row.skipped) == (2000, 400, 228, 684, 688)
    full = detect.classify(keyed, state, "full", fx.AS_OF)
    assert detect.to_process(full).count() == 628
    assert detect.new_rows(cls).count() == detect.new_rows_anti(keyed, state).count() == 400
