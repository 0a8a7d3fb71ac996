"""Stored-table materializations (K1-K10) on plain parquet directories."""

from tallyspark.sinks.tables import (compact, read_stored, table_exists, write_append_new,
                                     write_delete_insert, write_merge, write_table, file_counts)

__all__ = ["compact", "read_stored", "table_exists", "write_append_new", "write_delete_insert",
           "write_merge", "write_table", "file_counts"]
