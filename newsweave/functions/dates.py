"""Date and time expressions; timestamps are read as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Election days of the published feature set.
US_ELECTION = "2024-11-05"
FRENCH_ELECTION = "2024-07-07"
DAY_MICROS = 86_400_000_000
MOST_MILLIS = 9_223_372_036_854  # what 64-bit nanoseconds hold


def parse_lenient(value: Column) -> Column:
    """Timestamp, null where the text cannot be read."""
    return F.try_to_timestamp(value.cast("string"))


def parse_strict(value: Column) -> Column:
    """Timestamp; unreadable text is an error."""
    return F.to_timestamp(value)


def calendar_date(ts: Column) -> Column:
    return F.to_date(ts)


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def is_weekend(ts: Column) -> Column:
    """Saturday or Sunday; a null timestamp gives false."""
    return F.coalesce(F.weekday(ts) >= 5, F.lit(False))


def days_until(ts: Column, day: str) -> Column:
    """Whole days, rounded down, from the timestamp to midnight of ``day``."""
    gap = F.unix_micros(F.lit(f"{day} 00:00:00").cast("timestamp")) - F.unix_micros(ts)
    whole = gap - F.pmod(gap, F.lit(DAY_MICROS))
    return (whole / F.lit(DAY_MICROS)).cast("int")


def request_date(value: Column) -> Column:
    """Numeric text is epoch milliseconds and becomes a UTC date text; other text, numbers beyond 1677 to 2262 too, passes unchanged."""
    number = value.try_cast("double")
    millis = F.when(F.abs(number) <= MOST_MILLIS, F.floor(number).try_cast("bigint"))
    return F.coalesce(F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd"), value)


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
