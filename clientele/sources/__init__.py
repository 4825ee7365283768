"""Readers, load policies, audit columns and the adapters over the test tables."""
