"""Time stamping and date/hour text.

``ts`` is epoch milliseconds. Dates and hours are text (``yyyy-MM-dd``, ``HH``)
rendered in an explicit zone so results never depend on the host's zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_from_ntz(ts) -> Column:
    """Epoch ms of a zone-less timestamp read as UTC wall clock. Pure field arithmetic
    on the NTZ value (days, hour, minute, second with fraction), so no cast through
    the session zone happens; truncates to the millisecond."""
    t = _col(ts)
    day_ms = F.unix_date(t.cast("date")).cast("long") * F.lit(86_400_000)
    sec = F.extract(F.lit("SECOND"), t)           # decimal seconds with microseconds
    return day_ms + F.hour(t).cast("long") * 3_600_000 + F.minute(t).cast("long") * 60_000 \
        + F.floor(sec * 1000).cast("long")


def stamp_ms(clock=None) -> Column:
    """Arrival stamp in epoch ms. ``clock`` is a timestamp column (broker/file time);
    default ``current_timestamp()`` – one value per micro-batch, so keep a
    secondary order column when stamping with it."""
    clock = F.current_timestamp() if clock is None else _col(clock)
    return F.unix_millis(clock.cast("timestamp"))


def _is_utc(tz: str) -> bool:
    return tz.upper() in ("UTC", "Z", "GMT", "+00:00", "ETC/UTC")


def _wall_clock(ts_ms, tz: str) -> Column:
    """Zone-less wall clock of an epoch-ms instant in zone ``tz`` (no session zone involved)."""
    utc_wall = F.timestamp_add("MILLISECOND", _col(ts_ms), F.expr(_EPOCH_NTZ))
    return utc_wall if _is_utc(tz) else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def _date_text(ts_ms, tz: str) -> Column:
    if _is_utc(tz):
        days = F.floor(_col(ts_ms) / F.lit(86_400_000)).cast("int")
        return F.date_from_unix_date(days).cast("string")
    return _wall_clock(ts_ms, tz).cast("date").cast("string")


def _hour_text(ts_ms, tz: str) -> Column:
    if _is_utc(tz):
        hour = F.pmod(F.floor(_col(ts_ms) / F.lit(3_600_000)), F.lit(24))
    else:
        hour = F.hour(_wall_clock(ts_ms, tz))
    return F.lpad(hour.cast("string"), 2, "0")


def date_hour_text(ts_ms, tz: str = "UTC") -> Column:
    """Epoch ms → ``yyyy-MM-dd HH`` text in zone ``tz``."""
    return F.concat(_date_text(ts_ms, tz), F.lit(" "), _hour_text(ts_ms, tz))


def split_date_hour(text) -> tuple[Column, Column]:
    """Split ``yyyy-MM-dd HH`` on the space into (date, hour) text parts."""
    parts = F.split(_col(text), " ")
    return parts.getItem(0), parts.getItem(1)


def with_date_hour(df, ts_col: str = "ts", tz: str = "UTC",
                   date_col: str = "log_date", hour_col: str = "log_hour"):
    """Derive ``log_date``/``log_hour`` text from epoch-ms ``ts`` in zone ``tz``."""
    return df.withColumns({date_col: _date_text(ts_col, tz), hour_col: _hour_text(ts_col, tz)})


def as_of_date(clock=None, tz: str = "UTC") -> Column:
    """Today's date text from a clock (default: the query's current timestamp)."""
    return _date_text(stamp_ms(clock), tz)


def prev_day(date_text) -> Column:
    """Previous calendar day of a ``yyyy-MM-dd`` text; a bad date raises (ANSI cast)."""
    return F.date_sub(_col(date_text).cast("date"), 1).cast("string")


def check_date(date: str) -> str:
    """Validate a date parameter on the driver (bad text such as 2024-13-01 raises)."""
    return _dt.date.fromisoformat(date).isoformat()


def prev_day_str(date: str) -> str:
    return (_dt.date.fromisoformat(date) - _dt.timedelta(days=1)).isoformat()


def day_bounds(first_date: str, last_date: str | None = None) -> tuple[str, str]:
    """Half-open ``[first 00:00, last+1 00:00)`` wall-clock bounds of a day range, as text."""
    last = _dt.date.fromisoformat(last_date or first_date) + _dt.timedelta(days=1)
    return f"{check_date(first_date)} 00:00:00", f"{last.isoformat()} 00:00:00"
