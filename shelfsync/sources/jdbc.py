"""JDBC source and sink.

Reads are range-partitioned (``partitionColumn`` / bounds / ``numPartitions``)
so a large source table is fetched by many tasks, and Catalyst pushes filters
and the column list into the SQL sent to the database.

The sink is set-based, like bulk array parameters: the change set is written
in parallel into a staging table by Spark's JDBC writer (``batchsize`` rows
per round trip), then one MERGE statement applies upserts and data-only
updates inside the database.  Vectors travel as JSON text.  :class:`JdbcSink`
adds a ledger: the key of a change set is inserted in the transaction that
applies it, so one that is sent again changes nothing.
"""

from __future__ import annotations

import contextlib
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfsync.schema import UPDATE_COLUMNS


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return reader.load()


def execute(spark: SparkSession, url: str, statements: list[str], properties: dict | None = None) -> list[int]:
    """Run set-based statements (DDL, MERGE) on the database in one transaction from the driver;
    returns the update counts.  Never used for per-row work."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    driver = (properties or {}).get("driver")
    if driver:
        jvm.java.lang.Class.forName(driver)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    conn.setAutoCommit(False)  # all statements or none
    try:
        counts = []
        st = conn.createStatement()
        for sql in statements:
            st.execute(sql)
            counts.append(st.getUpdateCount())
        st.close()
        conn.commit()
        return counts
    finally:
        conn.rollback()  # nothing is left to undo after a commit
        conn.close()


#: A text column without a length, per dialect of the staging table.
TEXT_TYPES = {"postgresql": "TEXT", "mysql": "LONGTEXT", "standard": "VARCHAR(32672)"}
#: Destination types that text is not assigned to without a cast.
CASTS = {"postgresql": {"workspace_id": "uuid", "embedding": "vector"}}


def dialect_of(url: str) -> str:
    """``postgresql``, ``mysql`` or ``standard`` (MERGE), by the JDBC URL."""
    kind = url.split(":", 2)[1].lower()
    return {"postgresql": "postgresql", "mysql": "mysql", "mariadb": "mysql"}.get(kind, "standard")


def merge_statements(dialect: str, table: str, staging: str) -> list[str]:
    """Set-based statements that apply a staged change set: upserts replace
    every column including the vector; updates replace the ten data columns;
    updates without a match do nothing (they are the orphans)."""
    cols = ["id", "workspace_id", *UPDATE_COLUMNS, "embedding"]
    casts = CASTS.get(dialect, {})
    value = {c: f"CAST(s.{c} AS {casts[c]})" if c in casts else f"s.{c}" for c in cols}
    names, values = ", ".join(cols), ", ".join(value[c] for c in cols)
    match = f"t.id = s.id AND t.workspace_id = {value['workspace_id']}"
    if dialect == "postgresql":
        return [f"INSERT INTO {table} ({names}) SELECT {values} FROM {staging} s WHERE s.action = 'upsert' "
                f"ON CONFLICT (id, workspace_id) DO UPDATE SET {', '.join(f'{c} = EXCLUDED.{c}' for c in cols[2:])}",
                f"UPDATE {table} AS t SET {', '.join(f'{c} = {value[c]}' for c in UPDATE_COLUMNS)} "
                f"FROM {staging} s WHERE {match} AND s.action = 'update'"]
    if dialect == "mysql":
        return [f"INSERT INTO {table} ({names}) SELECT {values} FROM {staging} s WHERE s.action = 'upsert' "
                f"ON DUPLICATE KEY UPDATE {', '.join(f'{c} = VALUES({c})' for c in cols[2:])}",
                f"UPDATE {table} t JOIN {staging} s ON {match} AND s.action = 'update' "
                f"SET {', '.join(f't.{c} = {value[c]}' for c in UPDATE_COLUMNS)}"]
    data = ", ".join(f"{c} = s.{c}" for c in UPDATE_COLUMNS)
    return [f"MERGE INTO {table} t USING {staging} s ON {match} "
            f"WHEN MATCHED AND s.action = 'upsert' THEN UPDATE SET {data}, embedding = s.embedding "
            f"WHEN MATCHED AND s.action = 'update' THEN UPDATE SET {data} "
            f"WHEN NOT MATCHED AND s.action = 'upsert' THEN INSERT ({names}) VALUES ({values})"]


def vector_text(vector: Column) -> Column:
    """A vector as text (P19): a JSON array, which reads back to the same floats."""
    return F.to_json(vector)


def write_products_jdbc(changes: DataFrame, url: str, table: str, staging: str, *,
                        properties: dict | None = None, batch_size: int = 1000,
                        text_type: str | None = None, first: tuple[str, ...] = ()) -> list[int]:
    """Apply a staged change set (``action`` upsert/update) to a destination
    table over JDBC: parallel staging write, then the dialect's statements in
    one transaction, after those of ``first``.  ``text_type`` is the staging table's type of text (a
    value too long for it fails the write)."""
    dialect = dialect_of(url)
    # Update rows never write the vector, so they carry '' rather than NULL
    # (some dialects bind NULL text as CLOB, which VARCHAR columns refuse).
    vec = F.coalesce(vector_text(F.col("embedding")), F.lit(""))
    live = changes.filter(F.col("action").isin("upsert", "update")).select(
        "id", "workspace_id", *UPDATE_COLUMNS, vec.alias("embedding"), "action")
    if dialect == "standard":
        # Spark quotes the staging table's column names; the statements' plain
        # names fold to upper case here (to lower case in PostgreSQL).
        live = live.toDF(*[c.upper() for c in live.columns])
    kind = text_type or TEXT_TYPES[dialect]
    text_cols = [f.name for f in live.schema.fields if f.dataType.simpleString() == "string"]
    opts = dict(properties or {})
    opts.update({"batchsize": str(batch_size), "createTableColumnTypes": ", ".join(f"{c} {kind}" for c in text_cols)})
    live.write.jdbc(url, staging, mode="overwrite", properties=opts)
    return execute(changes.sparkSession, url, [*first, *merge_statements(dialect, table, staging)], properties)


class JdbcSink:
    """A destination table whose change sets are applied once each.

    ``ledger`` is a table of the destination, ``(run_key, digest)`` its primary
    key.  A change set's key is the run's (for a stream: its id and batch, so
    a replayed batch has the same), its digest a sum over its rows' hashes.
    The pair is inserted in the transaction that applies the rows: a change
    set that is there already is left alone, and of two senders at once one
    transaction fails as a whole.  Each run has a staging table of its own,
    dropped at the end.
    """

    def __init__(self, url: str, table: str, staging: str, *, ledger: str = "sync_ledger", properties: dict | None = None,
                 batch_size: int = 1000, text_type: str | None = None):
        self.url, self.table, self.staging, self.ledger = url, table, staging, ledger
        self.properties, self.batch_size, self.text_type = properties, batch_size, text_type

    def _applied(self, spark: SparkSession, key: str, digest: str) -> bool:
        found = spark.read.jdbc(self.url, f"(SELECT digest FROM {self.ledger} WHERE run_key = '{key}' AND digest = '{digest}') applied",
                                properties=self.properties or {})
        return found.count() > 0

    def create_ledger(self, spark: SparkSession) -> None:
        """Make the ledger where it is missing."""
        from py4j.protocol import Py4JJavaError

        try:
            execute(spark, self.url, [f"CREATE TABLE {self.ledger} (run_key VARCHAR(200) NOT NULL, digest VARCHAR(64) NOT NULL, "
                                      "PRIMARY KEY (run_key, digest))"], self.properties)
        except Py4JJavaError:
            self._applied(spark, "", "")  # it was there; anything else fails here too

    def apply(self, changes: DataFrame, key: str) -> bool:
        """Apply a change set; False where it had been applied before."""
        from py4j.protocol import Py4JJavaError

        spark = changes.sparkSession
        key = re.sub(r"[^A-Za-z0-9_.-]", "_", key)
        rows = F.xxhash64("workspace_id", "id", "action", *UPDATE_COLUMNS, F.to_json("embedding")).cast("decimal(38,0)")
        summed = changes.agg(F.count(F.lit(1)).alias("n"), F.sum(rows).alias("s")).first()
        digest = f"{summed['n']}:{summed['s'] or 0}"
        self.create_ledger(spark)
        if self._applied(spark, key, digest):
            return False
        staging = f"{self.staging}_{uuid.uuid4().hex[:12]}"
        try:
            write_products_jdbc(changes, self.url, self.table, staging, properties=self.properties, batch_size=self.batch_size,
                                text_type=self.text_type,
                                first=(f"INSERT INTO {self.ledger} (run_key, digest) VALUES ('{key}', '{digest}')",))
        except Py4JJavaError:
            if not self._applied(spark, key, digest):  # not another sender of the same rows
                raise
            return False
        finally:
            with contextlib.suppress(Py4JJavaError):  # it may never have been written
                execute(spark, self.url, [f"DROP TABLE {staging}"], self.properties)
        return True
