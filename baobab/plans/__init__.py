"""Query registry, stand-in inputs and the DuckDB oracle."""
