"""Composed plans: the sync chain, the tenant fixtures over the driver tables,
and the registered queries with their SQL oracles."""
