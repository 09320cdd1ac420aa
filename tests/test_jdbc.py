"""JDBC source and sink on embedded, in-memory Derby (inside the JVM; no server)."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F, types as T

from shelfsync.plans import fixtures as fx
from shelfsync.schema import PRODUCT
from shelfsync.sources.jdbc import execute, read_jdbc, write_products_jdbc

from conftest import SF001

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
T0 = dt.datetime(2023, 1, 1)


@pytest.fixture()
def url(spark, tmp_path):
    return f"jdbc:derby:memory:shelfsync_{tmp_path.name};create=true"


def test_partitioned_read_with_pushdown(spark, url):
    part = fx.table(spark, SF001, "part")
    part.write.jdbc(url, "PART", mode="overwrite", properties={**DERBY, "createTableColumnTypes":
                    "p_name VARCHAR(200), p_brand VARCHAR(50), p_type VARCHAR(50)"})
    df = read_jdbc(spark, url, "PART", properties=DERBY, partition_column="p_partkey",
                   lower_bound=0, upper_bound=200, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    q = df.filter(F.col("p_size") > 10).select("p_partkey", "p_name")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    assert "GreaterThan(p_size,10)" in plan and "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    assert q.count() == part.filter(F.col("p_size") > 10).count()


def test_merge_sink(spark, url):
    ddl = ("CREATE TABLE PRODUCTS (id VARCHAR(64) NOT NULL, workspace_id VARCHAR(64) NOT NULL, "
           "description VARCHAR(1000), display_name VARCHAR(1000), code VARCHAR(100), manufactory VARCHAR(100), "
           "price DOUBLE, promotion_price DOUBLE, promotion_start TIMESTAMP, promotion_end TIMESTAMP, stock INT, "
           "need_prescription BOOLEAN, embedding VARCHAR(32672), PRIMARY KEY (id, workspace_id))")
    execute(spark, url, [ddl, "INSERT INTO PRODUCTS VALUES ('1','w','old','old','c','m',1.0,5.0,"
                              "TIMESTAMP('2023-01-01 00:00:00'),TIMESTAMP('2023-01-01 00:00:00'),1,false,'[9.0]')",
                         "INSERT INTO PRODUCTS VALUES ('2','w','old','old','c','m',1.0,5.0,NULL,NULL,1,false,'[8.0]')"],
            DERBY)
    schema = T.StructType([*PRODUCT.fields, T.StructField("action", T.StringType())])

    def row(i, desc, emb, action):
        return ("w", i, desc, desc, "c", "m", 2.0, None, None, None, 3, True, emb, action)

    changes = spark.createDataFrame([row("1", "upserted", [1.0, 2.0], "upsert"), row("2", "updated", None, "update"),
                                     row("3", "inserted", [3.0], "upsert"), row("4", "orphan", None, "update"),
                                     row("5", "failed", None, "drop")], schema)
    write_products_jdbc(changes, url, "PRODUCTS", "PRODUCTS_STAGING", properties=DERBY)
    got = {r.ID: r for r in read_jdbc(spark, url, "PRODUCTS", properties=DERBY).collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert got["1"].DESCRIPTION == "upserted" and got["1"].EMBEDDING == "[1.0,2.0]"
    assert got["1"].PROMOTION_PRICE is None and got["1"].PROMOTION_START is None
    assert got["2"].DESCRIPTION == "updated" and got["2"].EMBEDDING == "[8.0]" and got["2"].PROMOTION_PRICE is None
    assert got["3"].EMBEDDING == "[3.0]" and got["3"].NEED_PRESCRIPTION is True
