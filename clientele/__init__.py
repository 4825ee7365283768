"""Customer analytics on Spark: four feeds, keyed tables, a star schema, thirteen views."""
