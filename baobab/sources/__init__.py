"""Sources and sinks: files, JDBC and the session catalog."""

from baobab.sources.catalog import create_view_as, list_tables, register_views
from baobab.sources.files import read_csv, read_json, read_parquet, read_text
from baobab.sources.jdbc import (
    JdbcConnection,
    execute_ddl,
    publish_table,
    read_back_check,
    read_query,
    read_table,
    write_table,
)

__all__ = [
    "JdbcConnection",
    "create_view_as",
    "execute_ddl",
    "list_tables",
    "publish_table",
    "read_back_check",
    "read_csv",
    "read_json",
    "read_parquet",
    "read_query",
    "read_table",
    "read_text",
    "register_views",
    "write_table",
]
