from strideframe.sources.readings import (
    ANONYMOUS_S3A,
    FILE_PATTERN,
    FOLDER_PATTERN,
    object_manifest,
    read_marked,
    read_readings,
    read_stream,
    read_streams,
    write_readings,
)
from strideframe.sources.storage import (
    drop_table,
    materialize,
    preview,
    read_or_compute,
    read_table,
    rows_written,
    scratch,
    shared_dir,
    shuffles_removed,
    table_exists,
    write_table,
)

__all__ = [
    "ANONYMOUS_S3A",
    "FILE_PATTERN",
    "FOLDER_PATTERN",
    "drop_table",
    "materialize",
    "object_manifest",
    "preview",
    "read_marked",
    "read_or_compute",
    "read_readings",
    "read_stream",
    "read_streams",
    "read_table",
    "rows_written",
    "scratch",
    "shared_dir",
    "shuffles_removed",
    "table_exists",
    "write_readings",
    "write_table",
]
