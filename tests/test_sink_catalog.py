"""The ledger of the JDBC sink and the catalog listings, on embedded in-memory Derby (no server)."""

import datetime as dt
import threading

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F, types as T

from shelfsync.config import ColumnMapping, SyncConfig
from shelfsync.operators.embed import hashing_embedder
from shelfsync.plans.sync import FunctionEmbedder, Tenant, run_sync
from shelfsync.schema import PRODUCT
from shelfsync.sources import catalog
from shelfsync.sources.jdbc import JdbcSink, execute, read_jdbc
from shelfsync.sources.store import TableStore

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
DDL = ("CREATE TABLE PRODUCTS (id VARCHAR(64) NOT NULL, workspace_id VARCHAR(64) NOT NULL, description VARCHAR(1000), "
       "display_name VARCHAR(1000), code VARCHAR(100), manufactory VARCHAR(100), price DOUBLE, promotion_price DOUBLE, "
       "promotion_start TIMESTAMP, promotion_end TIMESTAMP, stock INT, need_prescription BOOLEAN, embedding VARCHAR(32672), "
       "PRIMARY KEY (id, workspace_id))")
WS = "00000000-0000-0000-0000-00000000000a"


@pytest.fixture()
def url(spark, tmp_path):
    url = f"jdbc:derby:memory:sink_{tmp_path.name};create=true"
    execute(spark, url, [DDL], DERBY)
    return url


def changes(spark, price, n=3):
    schema = T.StructType([*PRODUCT.fields, T.StructField("action", T.StringType())])
    return spark.createDataFrame([("w", str(i), "d", "d", "c", "m", price, None, None, None, 1, True, [1.0], "upsert")
                                  for i in range(n)], schema)


def shown(spark, url):
    rows = read_jdbc(spark, url, "PRODUCTS", properties=DERBY).collect()
    return sorted((r.ID, r.PRICE) for r in rows), read_jdbc(spark, url, "sync_ledger", properties=DERBY).count()


def test_a_change_set_is_applied_once(spark, url):
    sink = JdbcSink(url, "PRODUCTS", "STAGING", properties=DERBY)
    assert sink.apply(changes(spark, 1.0), "s-0")
    execute(spark, url, ["UPDATE PRODUCTS SET price = 9.0 WHERE id = '1'"], DERBY)   # by somebody else, later
    before = shown(spark, url)
    assert not sink.apply(changes(spark, 1.0).repartition(3), "s-0") and shown(spark, url) == before
    assert sink.apply(changes(spark, 2.0), "s-0")                                    # other rows under the same key
    assert sink.apply(changes(spark, 2.0), "s-1")
    assert shown(spark, url) == ([(str(i), 2.0) for i in range(3)], 3)
    left = [r.table_name for r in catalog.jdbc_tables(spark, url, DERBY).collect()]
    assert left == ["PRODUCTS", "SYNC_LEDGER"]                                       # no staging table stays


def test_a_failed_merge_leaves_no_ledger_row(spark, url):
    sink = JdbcSink(url, "PRODUCTS", "STAGING", properties=DERBY)
    bad = changes(spark, 1.0).withColumn("code", F.repeat(F.lit("x"), 200))          # too long for the column
    with pytest.raises(Py4JJavaError, match="truncation"):
        sink.apply(bad, "s-0")
    assert shown(spark, url) == ([], 0)
    assert sink.apply(changes(spark, 1.0), "s-0") and len(shown(spark, url)[0]) == 3


def test_two_runs_at_once_do_not_share_staging(spark, url):
    sink, done = JdbcSink(url, "PRODUCTS", "STAGING", properties=DERBY), []
    sink.create_ledger(spark)

    def go(key, price):
        done.append(sink.apply(changes(spark, price, 5).filter("id " + ("<" if price == 1.0 else ">=") + " '2'"), key))

    threads = [threading.Thread(target=go, args=a) for a in (("a", 1.0), ("b", 2.0))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert done == [True, True]
    assert shown(spark, url) == ([("0", 1.0), ("1", 1.0), ("2", 2.0), ("3", 2.0), ("4", 2.0)], 2)


def test_a_run_that_dies_after_the_sink_is_sent_again_once(spark, url, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 2)
    src = spark.createDataFrame([(1, "a", "1", 1.0)], "id long, descricao string, codigo string, preco double")
    sink = JdbcSink(url, "PRODUCTS", "STAGING", properties=DERBY)

    def run():
        return run_sync(spark, store, [Tenant(src, SyncConfig(WS, ColumnMapping()))], sink=sink, stream_id="s", batch_id=0,
                        embedder=FunctionEmbedder(hashing_embedder(4), 10), as_of=dt.datetime(2024, 1, 1))

    real = store.begin

    def dies(snapshot=None):
        commit = real(snapshot)
        commit.publish = lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost"))
        return commit

    store.begin = dies
    with pytest.raises(RuntimeError, match="driver lost"):
        run()
    store.begin = real
    assert store.versions() == [] and shown(spark, url) == ([("1", 100.0)], 1)
    run()
    assert store.versions() == [0] and shown(spark, url) == ([("1", 100.0)], 1)


def test_listings(spark, url):
    assert [r.database for r in catalog.jdbc_databases(spark, url, DERBY).collect()] == ["APP"]
    cols = catalog.jdbc_columns(spark, url, "PRODUCTS", DERBY).collect()
    assert [c.ordinal_position for c in cols] == list(range(1, 14)) and [c.column_name for c in cols][:3] == ["ID", "WORKSPACE_ID", "DESCRIPTION"]
    assert catalog.jdbc_columns(spark, url, "O'NEIL", DERBY).count() == 0
    spark.range(1).createOrReplaceTempView("listed_here")
    assert "default" in [r.database for r in catalog.databases(spark).collect()]
    assert "listed_here" in [r.table_name for r in catalog.tables(spark).collect()]
    assert [tuple(r) for r in catalog.columns(spark, ["listed_here"]).collect()] == [("listed_here", "id", 1, "bigint")]
    spark.catalog.dropTempView("listed_here")


@pytest.mark.parametrize("dialect", ["postgresql", "mysql", "standard", "derby"])
def test_listing_queries_leave_out_the_systems_own(dialect):
    for what in ("databases", "tables", "columns"):
        assert "'x''y'" in catalog._listing(dialect, what, "x'y") or what != "columns"
    assert all(x in catalog._listing("mysql", "databases") for x in catalog.MYSQL_OWN)
    assert "NOT datistemplate" in catalog._listing("postgresql", "databases") and "'public'" in catalog._listing("postgresql", "tables")
