"""The scoring and monitoring jobs as Structured Streaming."""

from riskloom.streaming.operators import (
    active_alerts,
    alert_stream,
    windowed_performance,
    windowed_psi,
    windowed_summary,
)
from riskloom.streaming.sinks import latest_windows, run_windows, stream_respond, stream_validate
from riskloom.streaming.source import event_time, read_stream

__all__ = [
    "active_alerts",
    "alert_stream",
    "event_time",
    "latest_windows",
    "read_stream",
    "run_windows",
    "stream_respond",
    "stream_validate",
    "windowed_performance",
    "windowed_psi",
    "windowed_summary",
]
