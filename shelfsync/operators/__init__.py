"""Relational operators of a sync, each a DataFrame → DataFrame transform."""
