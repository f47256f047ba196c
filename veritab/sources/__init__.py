"""Schemas, dataset contracts, readers/writers and the test-data adapter views."""

from veritab.sources.adapters import adapter_tables, employee_calls, employee_details, sales_details
from veritab.sources.files import configure, read_csv, read_table, shared_dir, write_csv, write_parquet
from veritab.sources.schemas import (
    CALLS_SCHEMA,
    DETAILS_SCHEMA,
    EMPLOYEE_CALLS,
    EMPLOYEE_DETAILS,
    SALES_DETAILS,
    SALES_SCHEMA,
    SPECS,
    DatasetSpec,
    require_columns,
)
