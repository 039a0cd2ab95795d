"""Batch sources and sinks: delimited files, JDBC, warehouse tables."""

from casekit.sources.delimited import read_delimited, write_delimited
from casekit.sources.jdbc import jdbc_options, read_jdbc, write_jdbc
from casekit.sources.literal import literal_frame
from casekit.sources.tables import (ensure_table, overwrite_partitions, read_landing, read_table,
                                    rebuild_table, refresh_staging, spread_for_write,
                                    write_table)

__all__ = ["read_delimited", "write_delimited", "jdbc_options", "read_jdbc", "write_jdbc",
           "literal_frame", "ensure_table", "overwrite_partitions",
           "read_landing", "read_table", "rebuild_table", "refresh_staging", "spread_for_write", "write_table"]
