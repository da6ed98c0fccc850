"""Independent SQL statements of every registered query, for DuckDB."""

from .duckdb_sql import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
