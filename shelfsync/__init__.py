"""shelfsync — incremental product-catalog synchronisation on Spark.

Source tables are read through a column mapping, fingerprinted, compared with a
persisted state, normalised into one canonical product schema, enriched with
looked-up titles and embeddings, and merged into a keyed target table.  Every
stage is a DataFrame transform; Catalyst and AQE choose the physical plan.
"""

from shelfsync.config import ColumnMapping, SyncConfig, MODES

__all__ = ["ColumnMapping", "SyncConfig", "MODES"]
