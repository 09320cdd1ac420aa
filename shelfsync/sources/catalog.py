"""What a source holds: databases, tables and columns, as DataFrames.

A session's own catalog and a JDBC source give the same three listings; the
JDBC ones are one pushed-down query each, in the words of its dialect, and
leave out what belongs to the database system itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from shelfsync.sources.jdbc import dialect_of

#: MySQL's own databases.
MYSQL_OWN = ("information_schema", "mysql", "performance_schema", "sys")

_COLUMNS = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("column_name", T.StringType()),
                         T.StructField("ordinal_position", T.IntegerType()), T.StructField("data_type", T.StringType())])


def databases(spark: SparkSession) -> DataFrame:
    """``database`` of the session's catalog, by name."""
    return spark.createDataFrame(sorted((d.name,) for d in spark.catalog.listDatabases()), "database string")


def tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``table_name`` of tables and views, by name."""
    return spark.createDataFrame(sorted((t.name,) for t in spark.catalog.listTables(database)), "table_name string")


def columns(spark: SparkSession, names: list[str], database: str | None = None) -> DataFrame:
    """``table_name, column_name, ordinal_position, data_type`` of the given
    tables, in their columns' order (metadata: as many rows as columns)."""
    rows = [(name, c.name, i, c.dataType) for name in names
            for i, c in enumerate(spark.catalog.listColumns(f"{database}.{name}" if database else name), 1)]
    return spark.createDataFrame(rows, _COLUMNS)


def _listing(dialect: str, what: str, table: str | None = None) -> str:
    """The dialect's query for ``databases``, ``tables`` or ``columns``."""
    own = ", ".join(f"'{x}'" for x in MYSQL_OWN)
    name = (table or "").replace("'", "''")
    queries = {
        "postgresql": {
            "databases": "SELECT datname AS name FROM pg_database WHERE NOT datistemplate",
            "tables": "SELECT tablename AS name FROM pg_tables WHERE schemaname = 'public'",
            "columns": "SELECT column_name AS name, ordinal_position AS position FROM information_schema.columns "
                       f"WHERE table_schema = 'public' AND table_name = '{name}'"},
        "mysql": {
            "databases": f"SELECT schema_name AS name FROM information_schema.schemata WHERE schema_name NOT IN ({own})",
            "tables": "SELECT table_name AS name FROM information_schema.tables WHERE table_schema = DATABASE()",
            "columns": "SELECT column_name AS name, ordinal_position AS position FROM information_schema.columns "
                       f"WHERE table_schema = DATABASE() AND table_name = '{name}'"},
        "derby": {
            "databases": "SELECT schemaname AS name FROM sys.sysschemas WHERE schemaname NOT LIKE 'SYS%' "
                         "AND schemaname NOT IN ('NULLID', 'SQLJ')",
            "tables": "SELECT tablename AS name FROM sys.systables WHERE tabletype = 'T'",
            "columns": "SELECT c.columnname AS name, c.columnnumber AS position FROM sys.syscolumns c "
                       f"JOIN sys.systables t ON c.referenceid = t.tableid WHERE t.tablename = '{name}'"},
        "standard": {
            "databases": "SELECT schema_name AS name FROM information_schema.schemata WHERE schema_name <> 'information_schema'",
            "tables": "SELECT table_name AS name FROM information_schema.tables WHERE table_schema = CURRENT_SCHEMA",
            "columns": "SELECT column_name AS name, ordinal_position AS position FROM information_schema.columns "
                       f"WHERE table_schema = CURRENT_SCHEMA AND table_name = '{name}'"},
    }
    return queries[dialect][what]


def _read(spark: SparkSession, url: str, what: str, properties: dict | None, table: str | None = None) -> DataFrame:
    dialect = "derby" if url.startswith("jdbc:derby:") else dialect_of(url)
    query = _listing(dialect, what, table)
    found = spark.read.jdbc(url, f"({query}) listing", properties=properties or {})
    return found.toDF(*[c.lower() for c in found.columns])


def jdbc_databases(spark: SparkSession, url: str, properties: dict | None = None) -> DataFrame:
    """``database`` names of the server, without those of the system, by name."""
    return _read(spark, url, "databases", properties).selectExpr("trim(name) AS database").orderBy("database")


def jdbc_tables(spark: SparkSession, url: str, properties: dict | None = None) -> DataFrame:
    """``table_name`` of the connected database's tables, by name."""
    return _read(spark, url, "tables", properties).selectExpr("name AS table_name").orderBy("table_name")


def jdbc_columns(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """``column_name, ordinal_position`` of a table, in its columns' order."""
    found = _read(spark, url, "columns", properties, table)
    return found.selectExpr("name AS column_name", "CAST(position AS INT) AS ordinal_position").orderBy("ordinal_position")
