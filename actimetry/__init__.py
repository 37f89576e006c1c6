"""actimetry: activity and revenue metrics from application logs, built on Spark.

Layers (each a sub-package):

* ``sources``   – readers: driver tables, raw log lines, log streams, the DAU table.
* ``functions`` – column-level helpers (JSON, time stamping and formatting, keys).
* ``operators`` – DataFrame operators: routing, quarantine, dedup, anti-joins, metrics.
* ``sinks``     – writers: routed topics, raw archive, DAU table, previews, JSON documents.
* ``plans``     – dashboard reports and the registry of runnable queries.
* ``streaming`` – the Structured Streaming jobs (cross-batch first-per-device-per-day).
"""

from actimetry.config import get_or_create_session, scratch_dir

__all__ = ["get_or_create_session", "scratch_dir"]
