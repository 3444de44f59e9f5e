"""Scans, dictionaries and sinks."""

from lakeweir.sources.catalog import Catalog, Dataset
from lakeweir.sources.documents import read_dictionary, read_documents, read_pages
from lakeweir.sources.sinks import (
    append_log,
    latest_entries,
    landing_rows,
    materialize,
    read_landing,
    replace_partitions,
    replace_snapshot,
    split_quarantine,
    staged,
    upsert_landing,
    upsert_table,
    write_documents,
    write_report_jdbc,
)
from lakeweir.sources.versions import ConcurrentWriteError, read_table

__all__ = [
    "Catalog",
    "ConcurrentWriteError",
    "Dataset",
    "append_log",
    "landing_rows",
    "latest_entries",
    "materialize",
    "read_dictionary",
    "read_documents",
    "read_landing",
    "read_pages",
    "read_table",
    "replace_partitions",
    "replace_snapshot",
    "split_quarantine",
    "staged",
    "upsert_landing",
    "upsert_table",
    "write_documents",
    "write_report_jdbc",
]
