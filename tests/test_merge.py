"""Merge cases (FIXTURES §4)."""

import datetime as dt

from pyspark.sql import functions as F, types as T

from shelfsync.operators import merge
from shelfsync.schema import PRODUCT

AS_OF = dt.datetime(2024, 1, 1)
T0 = dt.datetime(2023, 1, 1)


def product(ws, id_, desc, promo=None, emb=(1.0,)):
    return (ws, id_, desc, desc, "c", "m", 100.0, promo, T0 if promo else None, T0 if promo else None, 1, False,
            list(emb) if emb is not None else None)


def changes_df(spark, rows):
    schema = T.StructType([*PRODUCT.fields, T.StructField("action", T.StringType()),
                           T.StructField("fingerprint", T.StringType())])
    return spark.createDataFrame(rows, schema)


def test_merge_cases(spark):
    target = spark.createDataFrame([product("w1", "1", "old", 50.0, (9.0,)), product("w1", "2", "old", 50.0, (8.0,)),
                                    product("w2", "1", "other ws", None, (7.0,))], PRODUCT)
    changes = changes_df(spark, [
        (*product("w1", "1", "new one", None, (1.0, 2.0)), "upsert", "f1"),   # key present: all replaced
        (*product("w1", "3", "inserted", None, (3.0,)), "upsert", "f3"),     # key absent: inserted
        (*product("w1", "2", "updated", None, None), "update", "f2"),        # changed: vector kept, promo cleared
        (*product("w1", "4", "orphan", None, None), "update", "f4"),         # changed, key absent: nothing
        (*product("w1", "5", "failed", None, None), "drop", "f5"),           # failed embed: nothing
    ])
    got = {(r.workspace_id, r.id): r for r in merge.merge_products(target, changes).collect()}
    assert set(got) == {("w1", "1"), ("w1", "2"), ("w1", "3"), ("w2", "1")}
    assert got[("w1", "1")].description == "new one" and got[("w1", "1")].embedding == [1.0, 2.0]
    assert got[("w1", "1")].promotion_price is None
    assert got[("w1", "2")].description == "updated" and got[("w1", "2")].embedding == [8.0]
    assert got[("w1", "2")].promotion_price is None and got[("w1", "2")].promotion_start is None
    assert got[("w1", "3")].embedding == [3.0]
    assert got[("w2", "1")].description == "other ws"
    orphans = merge.orphan_updates(target, changes).select("id").collect()
    assert [r.id for r in orphans] == ["4"]

    state = spark.createDataFrame([("w1", "1", "old1", T0), ("w1", "4", "old4", T0), ("w1", "5", "old5", T0)],
                                  "workspace_id string, id string, fingerprint string, updated_at timestamp_ntz")
    st = {r.id: r for r in merge.merge_state(state, changes, AS_OF).collect()}
    assert st["1"].fingerprint == "f1" and st["1"].updated_at == AS_OF
    assert st["4"].fingerprint == "f4"          # orphan: state still advances
    assert st["5"].fingerprint == "old5" and st["5"].updated_at == T0   # failed embed: untouched
    assert st["2"].fingerprint == "f2" and st["3"].fingerprint == "f3"


def test_upsert_rows_keeps_keys_unique(spark):
    t = spark.createDataFrame([("w", "1", 1), ("w", "2", 2)], "workspace_id string, id string, v int")
    r = spark.createDataFrame([("w", "2", 20), ("w", "3", 30)], "workspace_id string, id string, v int")
    got = sorted((x.id, x.v) for x in merge.upsert_rows(t, r).collect())
    assert got == [("1", 1), ("2", 20), ("3", 30)]
