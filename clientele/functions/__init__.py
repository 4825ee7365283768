"""Column expressions Spark does not ship in the form the feeds need."""
