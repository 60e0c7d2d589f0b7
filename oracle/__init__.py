"""The expected results of every registered query, as DuckDB SQL over the same files."""
