"""Content routing (startup vs event logs) and the quarantine of bad records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actimetry.schemas import CORRUPT_COL, STARTUP_TYPE, TOPIC_EVENT, TOPIC_START


def is_startup(type_col="type") -> Column:
    """Null-safe ``type == 'startup'``: a missing/null type is *not* startup (goes to EVENT)."""
    c = F.col(type_col) if isinstance(type_col, str) else type_col
    return c.eqNullSafe(F.lit(STARTUP_TYPE))


def route(df: DataFrame, type_col: str = "type") -> tuple[DataFrame, DataFrame]:
    """Two complementary filters: (startup logs, event logs). Every row lands in exactly one."""
    start = is_startup(type_col)
    return df.where(start), df.where(~start)


def with_topic(df: DataFrame, type_col: str = "type", topic_col: str = "topic",
               start_topic: str = TOPIC_START, event_topic: str = TOPIC_EVENT) -> DataFrame:
    """Add the destination topic; a Kafka sink honours a ``topic`` column, a file sink
    can ``partitionBy`` it. One pass, no duplication of the input."""
    return df.withColumn(topic_col, F.when(is_startup(type_col), F.lit(start_topic))
                         .otherwise(F.lit(event_topic)))


def _problem(required: tuple[str, ...]) -> Column:
    """Reason text for a bad record, null for a good one (first failing check wins)."""
    expr = F.when(F.col(CORRUPT_COL).isNotNull(), F.lit("malformed_json"))
    for c in required:
        expr = expr.when(F.col(c).isNull(), F.lit(f"null_{c}"))
    return expr


def tag_problems(df: DataFrame, required: tuple[str, ...] = ("mid", "ts")) -> DataFrame:
    """``df`` with ``reason``: null for a good row, else why it is rejected. A frame without ``_corrupt_record`` (from
    ``parse_logs``) is treated as well-formed."""
    if CORRUPT_COL not in df.columns:
        df = df.withColumn(CORRUPT_COL, F.lit(None).cast("string"))
    return df.withColumn("reason", _problem(required))


def split_valid(df: DataFrame, required: tuple[str, ...] = ("mid", "ts")) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``reason``)."""
    tagged = tag_problems(df, required)
    good = tagged.where(F.col("reason").isNull()).drop("reason", CORRUPT_COL)
    bad = tagged.where(F.col("reason").isNotNull())
    return good, bad
