"""Epoch and calendar conversions.

`zone=None` means the session time zone. Parsing takes a fixed offset, +08:00 unless told otherwise.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 24 * 60 * 60 * 1000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_clock(ms, zone: str | None = None) -> Column:
    """Local date and time of an epoch in milliseconds."""
    instant = F.timestamp_millis(_col(ms))
    if zone is None:
        return instant.cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def day_of(ms, zone: str | None = None) -> Column:
    return F.to_date(wall_clock(ms, zone))


def ts_to_date(ms, zone: str | None = None) -> Column:
    return F.date_format(wall_clock(ms, zone), "yyyy-MM-dd")


def ts_to_datetime(ms, zone: str | None = None) -> Column:
    return F.date_format(wall_clock(ms, zone), "yyyy-MM-dd HH:mm:ss")


def ts_to_partition(ms, zone: str | None = None) -> Column:
    return F.date_format(wall_clock(ms, zone), "yyyyMMdd")


def datetime_to_ts(text, offset: str = "+08:00") -> Column:
    """`yyyy-MM-dd HH:mm:ss` at a fixed offset -> epoch milliseconds; NULL when it does not parse."""
    stamped = F.concat(_col(text), F.lit(offset))
    return F.unix_millis(F.try_to_timestamp(stamped, F.lit("yyyy-MM-dd HH:mm:ssXXX")))


def date_to_ts(text, offset: str = "+08:00") -> Column:
    return datetime_to_ts(F.concat(_col(text), F.lit(" 00:00:00")), offset)


def event_time(seconds) -> Column:
    """Event time of a change-log record."""
    return F.timestamp_seconds(_col(seconds))


def proc_time() -> Column:
    """Processing time; constant within a micro-batch."""
    return F.current_timestamp()
