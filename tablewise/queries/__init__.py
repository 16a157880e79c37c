"""Named queries over the driver tables, each paired with DuckDB SQL."""
