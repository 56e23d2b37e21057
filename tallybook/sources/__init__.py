"""Readers: raw CSV, the star schema, exported KPI files, external databases."""

from tallybook.sources.csv import file_encodings, read_csv_facts, read_csv_source, read_sources
from tallybook.sources.database import read_database
from tallybook.sources.kpi_files import KPI_SCHEMAS, read_kpi_files, read_kpi_typed, require_rows
from tallybook.sources.star import SALES_COLUMNS, read_table, sales_orders

__all__ = [
    "KPI_SCHEMAS",
    "SALES_COLUMNS",
    "file_encodings",
    "read_csv_facts",
    "read_csv_source",
    "read_database",
    "read_kpi_files",
    "read_kpi_typed",
    "read_sources",
    "read_table",
    "require_rows",
    "sales_orders",
]
