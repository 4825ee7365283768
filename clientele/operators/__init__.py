"""Operators over DataFrames: lookup join, keyed upsert, surrogate keys, quality, run log."""
