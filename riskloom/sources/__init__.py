"""Table and request sources, result sinks."""

from riskloom.sources.sinks import to_batch_response, write_summary, write_table
from riskloom.sources.tables import explode_requests, load_labeled, read_table, read_with_fallback

__all__ = [
    "explode_requests",
    "load_labeled",
    "read_table",
    "read_with_fallback",
    "to_batch_response",
    "write_summary",
    "write_table",
]
