"""DataFrame operators: routing and dedup and anti-joins, metrics."""

from actimetry.operators.route import route, with_topic, split_valid, tag_problems
from actimetry.operators.dedup import (
    first_per_key, anti_asof, anti_by_date, distinct_devices, first_with_count,
)
from actimetry.operators.metrics import (
    by_date, dau_total, dau_daily, dau_hours, gmv_total, gmv_hours, hour_map, first_seen,
    new_device_total, new_device_hours, money_sum, stage_counts,
)

__all__ = [
    "route", "with_topic", "split_valid", "tag_problems",
    "first_per_key", "anti_asof", "anti_by_date", "distinct_devices", "first_with_count",
    "by_date", "dau_total", "dau_daily", "dau_hours", "gmv_total", "gmv_hours", "hour_map",
    "first_seen", "new_device_total", "new_device_hours", "money_sum", "stage_counts",
]
