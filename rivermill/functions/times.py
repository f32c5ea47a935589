"""Date and time scalars, all in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the output columns.
DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
PARTITION_DATE = "yyyyMMdd"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_to_ms(value: Column | str) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss`` text, null when malformed."""
    return F.unix_millis(F.try_to_timestamp(_col(value), F.lit(DATE_TIME)))


def date_text_to_ms(value: Column | str) -> Column:
    """Epoch milliseconds of midnight of ``yyyy-MM-dd`` text."""
    return F.unix_millis(F.try_to_timestamp(_col(value), F.lit(DATE)))


def ms_to_date(value: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(_col(value)), DATE)


def ms_to_date_time(value: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(_col(value)), DATE_TIME)


def ms_to_partition(value: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(_col(value)), PARTITION_DATE)


def ms_to_day(value: Column | str) -> Column:
    """Day of epoch milliseconds as DATE: four bytes in shuffles and state, unlike text."""
    return F.to_date(F.timestamp_millis(_col(value)))


def midnight_ms(day: Column | str) -> Column:
    """Epoch milliseconds of the start of a DATE."""
    return F.unix_millis(_col(day).cast("timestamp"))


def ms_to_time(value: Column | str) -> Column:
    return F.timestamp_millis(_col(value))


def seconds_to_time(value: Column | str) -> Column:
    return F.timestamp_seconds(_col(value))
