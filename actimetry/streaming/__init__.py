"""Structured Streaming jobs: the collector (stamp, archive, route) and the cross-batch
first-log-per-device-per-day consumer."""

from actimetry.streaming.dau_stream import (
    DailyCountSink, DauTable, replay_in_slices, start_console_preview, start_daily_count_stream,
    start_dau_stream, start_dropdup_stream, start_bounded_stream, distinct_keys,
)
from actimetry.streaming.collector import (
    Collector, JsonDauConsumer, parse_startup, stamp_lines, start_collector_stream,
    start_json_dau_stream,
)

__all__ = ["DailyCountSink", "start_daily_count_stream", "DauTable", "start_dau_stream", "start_dropdup_stream", "start_bounded_stream", "distinct_keys", "replay_in_slices",
           "start_console_preview", "Collector", "JsonDauConsumer", "parse_startup",
           "stamp_lines", "start_collector_stream", "start_json_dau_stream"]
