"""Event-time parsing and date partition columns."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepts whole seconds and microseconds, with 'Z' or a numeric offset.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def parse_event_time(c: Column | str) -> Column:
    """Text -> UTC wall-clock TIMESTAMP_NTZ; unparseable text -> NULL.

    The offset in the text fixes the instant, and the conversion to UTC is
    explicit, so the result is the same under any session time zone.
    """
    col = F.col(c) if isinstance(c, str) else c
    instant = F.try_to_timestamp(col, F.lit(EVENT_TIME_PATTERN))
    return utc_wall(instant)


def utc_wall(c: Column) -> Column:
    """TIMESTAMP -> UTC wall-clock TIMESTAMP_NTZ, from its microseconds: no local time (and no repeated hour) in between."""
    seconds = (F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def utc_instant(c: Column) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> TIMESTAMP; the text names its zone, so the session's plays no part."""
    return F.concat(c.cast("string"), F.lit("Z")).cast("timestamp")


def as_utc_ntz(c: Column | str) -> Column:
    """Normalise a TIMESTAMP or TIMESTAMP_NTZ column to UTC wall-clock NTZ.

    The driver's test tables already hold UTC wall-clock NTZ values.
    """
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz")


def render_event_time(c: Column | str, with_micros: Column | bool = True) -> Column:
    """UTC wall-clock NTZ -> ISO text with 'Z' (the landing format)."""
    col = F.col(c) if isinstance(c, str) else c
    micro = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if isinstance(with_micros, bool):
        return micro if with_micros else whole
    return F.when(with_micros, micro).otherwise(whole)


def date_partitions(ts: Column | str = "timestamp") -> dict[str, Column]:
    """year 'yyyy', month 'MM', day 'dd' as text (zero-padded)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return {
        "year": F.date_format(col, "yyyy"),
        "month": F.date_format(col, "MM"),
        "day": F.date_format(col, "dd"),
    }


def event_date(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """Partition strings back to a DATE."""
    return F.make_date(F.col(year).cast("int"), F.col(month).cast("int"), F.col(day).cast("int"))


def hours_before(as_of: str, hours: int = 25) -> str:
    """The cut-off ``hours`` before ``as_of`` (both 'yyyy-MM-ddTHH:mm:ss', UTC); a parameter, never the clock."""
    return (datetime.fromisoformat(as_of) - timedelta(hours=hours)).isoformat(timespec="seconds")
