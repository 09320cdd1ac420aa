"""Every registered query against its DuckDB oracle (sf0.001), plus
independence from shuffle partitions and the session time zone."""

import datetime as dt
import hashlib
import math

import duckdb
import pytest

from shelfsync.plans.queries import ORACLE, QUERIES

from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_every_query_has_rows(spark):
    for name, fn in QUERIES.items():
        assert fn(spark, SF001).limit(1).count() == 1, name


@pytest.mark.parametrize("name", ["sync_end_to_end", "dedupe_keys", "stream_sync"])
def test_independent_of_partitions_and_time_zone(spark, name):
    base = digest(QUERIES[name](spark, SF001).columns, [tuple(r) for r in QUERIES[name](spark, SF001).collect()])
    old_p = spark.conf.get("spark.sql.shuffle.partitions")
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        df = QUERIES[name](spark, SF001)
        assert digest(df.columns, [tuple(r) for r in df.collect()]) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old_p)
        spark.conf.set("spark.sql.session.timeZone", old_tz)
