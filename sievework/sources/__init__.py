"""Readers and writers."""

from sievework.sources.delimited import (
    bad_line_count,
    header_columns,
    land_delimited,
    landed_rows,
    quarantined_lines,
    read_delimited,
    staged_rows,
)
from sievework.sources.documents import document_check, document_counts, read_json_document, write_json_document
from sievework.sources.inventory import file_checksums, file_inventory
from sievework.sources.tables import (
    PublishConflict,
    current_path,
    head_sample,
    land_raw,
    latest_version,
    publish,
    publish_version,
    published_version,
    read_latest,
    read_processed,
    write_features,
    write_processed,
)

__all__ = [
    "PublishConflict",
    "bad_line_count",
    "current_path",
    "document_check",
    "document_counts",
    "file_checksums",
    "file_inventory",
    "head_sample",
    "header_columns",
    "land_raw",
    "latest_version",
    "publish",
    "publish_version",
    "published_version",
    "land_delimited",
    "landed_rows",
    "quarantined_lines",
    "staged_rows",
    "read_delimited",
    "read_json_document",
    "read_latest",
    "read_processed",
    "write_features",
    "write_json_document",
    "write_processed",
]
