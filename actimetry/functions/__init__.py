"""Column-level helpers; every one returns a JVM-side ``Column`` (no Python UDFs)."""

from actimetry.functions.jsonfmt import json_field, json_value, parse_logs, to_json_record, stamp_json, stamp_text
from actimetry.functions.keys import composite_key, namespaced_key, upper_columns, select_columns
from actimetry.functions.timefmt import (
    as_of_date, date_hour_text, day_bounds, epoch_ms_from_ntz, prev_day, split_date_hour,
    stamp_ms, with_date_hour,
)

__all__ = [
    "json_field", "json_value", "parse_logs", "to_json_record", "stamp_json", "stamp_text",
    "composite_key", "namespaced_key", "upper_columns", "select_columns",
    "as_of_date", "date_hour_text", "day_bounds", "epoch_ms_from_ntz", "prev_day",
    "split_date_hour", "stamp_ms", "with_date_hour",
]
