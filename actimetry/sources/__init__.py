"""Readers: driver tables and their log/order views, raw lines, log streams, the DAU table."""

from actimetry.sources.tables import (
    read_table, logs_from_events, orders_from_events, raw_lines_from_events, events_in_days,
)
from actimetry.sources.logs import (
    admission, read_raw_lines, read_log_stream, read_dau_table, seen_keys, dau_table_schema,
)

__all__ = [
    "read_table", "logs_from_events", "orders_from_events", "raw_lines_from_events",
    "events_in_days", "admission", "read_raw_lines", "read_log_stream", "read_dau_table", "seen_keys",
    "dau_table_schema",
]
