"""A target table bucketed on the merge key.

Each version is one table of the session catalog, written with ``bucketBy``
and ``sortBy`` on (workspace_id, id).  Joining changes to it on that key needs
no exchange on the table's side, however large it is: Spark hashes the changes
into the table's buckets and reads each bucket where it is merged.  The merged
rows come out in the same buckets, so writing the next version shuffles
nothing either.  Versions are never changed; the caller moves its pointer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfsync.operators.merge import merge_products
from shelfsync.schema import KEYS
from shelfsync.session import scratch_path


class BucketedTable:
    """One version of a bucketed table: its catalog name and its folder under ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int, name: str):
        self.spark, self.root, self.buckets, self.name = spark, root, buckets, name

    @classmethod
    def create(cls, rows: DataFrame, root: str, buckets: int) -> BucketedTable:
        """Write ``rows`` (one row a key) as a new version."""
        name = f"products_{uuid.uuid4().hex}"
        (rows.write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS)
         .option("path", f"{root.rstrip('/')}/{name}").saveAsTable(name))
        return cls(rows.sparkSession, root, buckets, name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merged(self, changes: DataFrame) -> DataFrame:
        """The table with ``changes`` applied as by :func:`merge_products`; only
        the changes are shuffled.  ``changes`` is a stored table: were its
        workspace a literal in the plan, the optimizer would take it out of the
        join key, and the table's buckets would not fit the rest."""
        return merge_products(self.read(), changes)

    def merge(self, changes: DataFrame) -> BucketedTable:
        """Store the changes and write the merged rows as the next version."""
        staged = scratch_path(self.spark, "bucketed-changes")
        changes.write.parquet(staged)
        return BucketedTable.create(self.merged(self.spark.read.schema(changes.schema).parquet(staged)), self.root, self.buckets)

    def drop(self) -> None:
        """Forget the version; its files stay for whoever still reads them."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
