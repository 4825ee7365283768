"""An independent statement of every query in DuckDB SQL."""
