from .files import path_exists
from .increments import Increment, load_increment
from .readers import (
    CORRUPT,
    jdbc_read_options,
    preflight,
    read_csv,
    read_database,
    read_files,
    read_increment,
    read_reference,
    read_sql,
    retain,
)
from .retention import Purge, purge_table
from .schema import avro_schema, declare, enforce_schema, schema_drift
from .versions import clean_versions, read_table, table_version
from .writers import (
    jdbc_write_options,
    merge_into_table,
    table_path,
    write_csv,
    write_database,
    write_table,
)

__all__ = [
    "CORRUPT",
    "Increment",
    "Purge",
    "avro_schema",
    "clean_versions",
    "declare",
    "enforce_schema",
    "jdbc_read_options",
    "jdbc_write_options",
    "load_increment",
    "merge_into_table",
    "path_exists",
    "preflight",
    "purge_table",
    "read_csv",
    "read_database",
    "read_files",
    "read_increment",
    "read_reference",
    "read_sql",
    "read_table",
    "retain",
    "schema_drift",
    "table_path",
    "table_version",
    "write_csv",
    "write_database",
    "write_table",
]
