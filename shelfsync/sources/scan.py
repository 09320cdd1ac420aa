"""Source scans through a column mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsync.config import REQUIRED_ROLES, ColumnMapping
from shelfsync.functions.fingerprint import fingerprint_of
from shelfsync.functions.js import js_string


class MappingError(ValueError):
    """A mapped column is missing from the source, or a required role is unset."""


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Any file or JDBC source Spark can read; filters and projections applied
    later are pushed into the scan by Catalyst."""
    reader = spark.read.format(fmt)
    if options:
        reader = reader.options(**{k: str(v) for k, v in options.items()})
    return reader.load(path) if path else reader.load()


def validate_mapping(df: DataFrame, mapping: ColumnMapping) -> None:
    """Fail before any job starts when the mapping does not fit the source."""
    unset = [r for r in REQUIRED_ROLES if not getattr(mapping, r)]
    if unset:
        raise MappingError(f"required roles not mapped: {unset}")
    missing = [c for c in mapping.source_columns() if c not in df.columns]
    if missing:
        raise MappingError(f"mapped columns missing from source: {missing}")


def mapped_scan(df: DataFrame, mapping: ColumnMapping) -> DataFrame:
    """Only the mapped columns, in mapping order, each once."""
    validate_mapping(df, mapping)
    return df.select(*mapping.source_columns())


def spread(df: DataFrame, partitions: int | None = None, by: str | None = None) -> DataFrame:
    """Deal the rows out over ``partitions`` tasks (None: leave them), or by
    the hash of the column ``by`` over as many as a shuffle has.

    An unpartitioned JDBC read is one task, and so is one large file with a
    single row group; the per-row work after the scan (fingerprint, text
    rules, the map side of deduplication) would then run on one core.  Whether
    a source is so narrow is known to whoever configures it, so this is a
    plain setting: nothing is counted and no threshold decides.  The
    repartition is round-robin, so a key that holds a third of the rows is
    split evenly too; Spark sorts each split before dealing its rows out
    (``spark.sql.execution.sortBeforeRepartition``), so a task retried after
    an executor loss sends the same rows to the same places.

    ``by`` is for a source that is grouped or joined by one column next: its
    raw rows are dealt out once, and what is computed from them (fingerprints
    do not compress) need not be shuffled.  The rows of one key meet in one
    task, as the grouping or join would have it.
    """
    if by:
        return df.repartition(by)
    return df.repartition(partitions) if partitions else df


def source_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def order_value(c, dtype):
    """A snapshot order column as BIGINT: timestamps in microseconds, dates
    in days, integers as they are."""
    from pyspark.sql import types as T

    if isinstance(dtype, T.TimestampNTZType):
        # microseconds since the epoch of the wall-clock value, whatever the session time zone
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    raise TypeError(f"order column must be a timestamp, date or integer, not {dtype.simpleString()}")


def keyed_columns(mapping: ColumnMapping, types: dict, extra: dict[str, str] | None = None) -> list:
    """The keyed scan's columns after ``workspace_id``: ``id``, ``fingerprint``
    and the raw role values, for source columns of the given types.  Sources
    that share a mapping and column types share these expressions, so many
    tenants of one shop system build them once."""
    roles = [F.col(c).alias(f"_r_{r}") for r, c in mapping.roles()]
    roles += [order_value(F.col(c), types[c]).alias(name) for name, c in (extra or {}).items()]
    return [js_string(F.col(mapping.id), types[mapping.id]).alias("id"),
            fingerprint_of(mapping.source_columns(), types).alias("fingerprint"),
            *roles]


def keyed_source(df: DataFrame, mapping: ColumnMapping, workspace_id: str,
                 extra: dict[str, str] | None = None, columns: list | None = None,
                 keep_null_ids: bool = False) -> DataFrame:
    """The mapped scan keyed for a sync.

    Columns: ``workspace_id``, ``id`` (the source id as text), ``fingerprint``
    (over the raw mapped values), and one ``_r_<role>`` column per mapped role
    holding the raw value.  Rows with a null id are dropped here, unless
    ``keep_null_ids`` leaves them for the caller to count and drop.  ``columns`` may pass in
    :func:`keyed_columns` already built for this mapping and these types.
    """
    validate_mapping(df, mapping)
    if columns is None:
        columns = keyed_columns(mapping, {f.name: f.dataType for f in df.schema.fields}, extra)
    keyed = df.select(F.lit(workspace_id).alias("workspace_id"), *columns)
    return keyed if keep_null_ids else keyed.filter(F.col("id").isNotNull())
