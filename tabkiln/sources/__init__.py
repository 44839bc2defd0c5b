"""Sources and sinks: parquet/CSV tables, text documents, report tables."""

from tabkiln.sources.tables import (
    TABLES,
    load_table,
    read_csv,
    read_text_documents,
    write_bucketed,
    write_csv,
    write_parquet,
    write_reports,
)

__all__ = [
    "TABLES",
    "load_table",
    "read_csv",
    "read_text_documents",
    "write_bucketed",
    "write_csv",
    "write_parquet",
    "write_reports",
]
