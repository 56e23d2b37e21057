"""Writers: cleaned tables, catalog tables, databases, KPI files, latest and archive."""

from tallybook.sinks.files import latest_and_archive, stage, write_cleaned, write_kpi
from tallybook.sinks.tables import (
    TABLES,
    load_all,
    load_table,
    loader_columns,
    write_database,
)

__all__ = [
    "TABLES",
    "latest_and_archive",
    "load_all",
    "load_table",
    "loader_columns",
    "stage",
    "write_cleaned",
    "write_database",
    "write_kpi",
]
