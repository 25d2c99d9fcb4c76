from tallyloom.sources.staging import checkpoint_root, stage
from tallyloom.sources.tables import (
    read_csv_table,
    read_features,
    read_json_report,
    read_raw_tables,
    write_csv,
    write_features,
    write_json_report,
    write_raw_tables,
)

__all__ = [
    "checkpoint_root",
    "read_csv_table",
    "read_features",
    "read_json_report",
    "read_raw_tables",
    "stage",
    "write_csv",
    "write_features",
    "write_json_report",
    "write_raw_tables",
]
