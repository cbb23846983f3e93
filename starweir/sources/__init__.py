"""Reading and writing tables: files, SQL databases, the raw layer."""

from starweir.sources.files import (
    conform,
    import_delimited,
    misfits,
    read_csv,
    read_table,
    write_table,
)
from starweir.sources.ingest import IngestError, ingest_summary, ingest_tables, land_csv_folder
from starweir.sources.jdbc import JdbcDatabase
from starweir.sources.records import Dialect, csv_records, parse_records

__all__ = [
    "Dialect",
    "IngestError",
    "JdbcDatabase",
    "conform",
    "csv_records",
    "import_delimited",
    "ingest_summary",
    "ingest_tables",
    "land_csv_folder",
    "misfits",
    "parse_records",
    "read_csv",
    "read_table",
    "write_table",
]
