"""Table writes, quarantine writes, audit records and run summaries."""

from orderlake.sinks.tables import (  # noqa: F401
    AuditLog, TableStore, layer_row_counts, write_table)
