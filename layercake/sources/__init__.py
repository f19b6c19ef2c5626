from layercake.sources.files import (
    export_json,
    read_if_exists,
    read_json,
    read_table,
    with_declared,
    write_table,
)
from layercake.sources.lake import BUCKET, Batch, Lake, distinct_buckets, together
from layercake.sources.report import inventory, preview, preview_tables, storage_report
from layercake.sources.workspace import new_folder, stage

__all__ = [
    "BUCKET",
    "Batch",
    "Lake",
    "distinct_buckets",
    "export_json",
    "inventory",
    "new_folder",
    "preview",
    "preview_tables",
    "read_if_exists",
    "read_json",
    "read_table",
    "stage",
    "storage_report",
    "together",
    "with_declared",
    "write_table",
]
