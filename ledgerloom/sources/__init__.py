from .readers import jdbc_options, read_csv, read_jdbc, row_cap, sample_rows
from .shared import checkpoint, drop_scratch, free_files, scratch_path
from .sinks import (
    load_params,
    read_snapshot,
    save_params,
    write_csv,
    write_snapshot,
)

__all__ = [
    "checkpoint",
    "drop_scratch",
    "free_files",
    "jdbc_options",
    "load_params",
    "read_csv",
    "read_jdbc",
    "read_snapshot",
    "row_cap",
    "sample_rows",
    "save_params",
    "scratch_path",
    "write_csv",
    "write_snapshot",
]
