"""Reading raw files and layer tables, writing tables and reports."""

from silverline.sources.by_key import ByKey, join_by_key, open_by_key, write_by_key
from silverline.sources.readers import (
    csv_headers,
    json_fields,
    open_tables,
    read_csv_text,
    read_json_lines,
    read_json_records,
    read_table,
)
from silverline.sources.scratch import materialised, scratch_folder
from silverline.sources.writers import write_json, write_table

__all__ = [
    "ByKey",
    "csv_headers",
    "join_by_key",
    "json_fields",
    "materialised",
    "open_by_key",
    "open_tables",
    "read_csv_text",
    "read_json_lines",
    "read_json_records",
    "read_table",
    "scratch_folder",
    "write_by_key",
    "write_json",
    "write_table",
]
