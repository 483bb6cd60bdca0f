"""Time parsing and 15-minute intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time formats of the messages.
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SPI_12H = "MM/dd/yyyy hh:mm:ss a"
SPI_24H = "MM/dd/yyyy HH:mm:ss"


def parse_time(text: Column, *formats: str) -> Column:
    """First format that fits, at whole seconds; NULL when none does."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats or (ISO,)]
    return F.date_trunc("second", F.coalesce(*tries))


def inspection_time(text: Column) -> Column:
    """Inspection times come with a 12-hour or a 24-hour clock."""
    return parse_time(text, SPI_12H, SPI_24H)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def interval_id(ts: Column, minutes: int = 15, compat: bool = False) -> Column:
    """Start of the interval that holds `ts`, in epoch milliseconds.

    `compat` gives the historic ids: a time in the first quarter of an hour counts to
    minute 45 of that hour, a time on a boundary counts to the quarter before it, and
    the seconds stay in the id.
    """
    if not compat:
        width = minutes * 60_000
        millis = F.unix_millis(ts)
        return millis - F.pmod(millis, F.lit(width))
    seconds = F.unix_seconds(ts)
    minute = F.pmod(F.floor(seconds / 60), F.lit(60))
    shown = (
        F.when((minute > 15) & (minute <= 30), 15)
        .when((minute > 30) & (minute <= 45), 30)
        .otherwise(45)
    )
    return ((seconds + (shown - minute) * 60) * 1000).cast("long")


def or_default(ts: Column, as_of) -> Column:
    """`as_of` where the time is missing."""
    return F.coalesce(ts, F.lit(as_of).cast("timestamp"))


def trailing(ts: Column, as_of, hours: int = 24) -> Column:
    """True for times later than `hours` before `as_of`, compared at whole seconds."""
    start = F.unix_seconds(F.lit(as_of).cast("timestamp")) - hours * 3600
    return F.unix_seconds(ts) > start
