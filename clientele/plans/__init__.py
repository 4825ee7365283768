"""The transforms: ingest, silver, gold, views."""
