"""Key building and column-list shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actimetry.schemas import DAU_KEY_PREFIX, DAU_COLUMNS, DAU_SINK_NAMES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def composite_key(*cols, sep: str = "_") -> Column:
    """``a_b`` text key; a null part prints as ``null`` (string interpolation semantics).
    Joins and groups should use the columns themselves; this is for display/export."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols])


def namespaced_key(date_col="log_date", prefix: str = DAU_KEY_PREFIX) -> Column:
    """Per-day set name ``DAU:<date>``."""
    return F.concat(F.lit(prefix), _col(date_col))


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name (names as the wide sink table stores them)."""
    return df.toDF(*[c.upper() for c in df.columns])


def sink_columns(df: DataFrame) -> DataFrame:
    """The eleven columns of the wide sink table under its own names; absent ones are typed nulls."""
    return select_columns(df, DAU_COLUMNS, fill_missing=True).toDF(*DAU_SINK_NAMES)


def select_columns(df: DataFrame, cols: list[str], fill_missing: bool = False) -> DataFrame:
    """Select ``cols`` in the given order; with ``fill_missing`` absent ones become typed nulls."""
    present = set(df.columns)
    out = []
    for c in cols:
        if c in present:
            out.append(F.col(c))
        elif fill_missing:
            out.append(F.lit(None).cast("string").alias(c))
        else:
            raise ValueError(f"column {c!r} not in {df.columns}")
    return df.select(*out)
