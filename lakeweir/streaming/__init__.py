"""Structured Streaming forms of the loads, the deduplication and the breaker state."""

from lakeweir.streaming.breaker import breaker_stream, latest_states
from lakeweir.streaming.late import dedup_with_late_rows, late_counts, late_rows
from lakeweir.streaming.loads import dedup_stream, run_available, stream_files, upsert_stream

__all__ = [
    "breaker_stream", "dedup_stream", "dedup_with_late_rows", "late_counts", "late_rows", "latest_states", "run_available",
    "stream_files", "upsert_stream",
]
