"""Dates that arrive as text in several shapes.

All comparisons use TIMESTAMP_NTZ, i.e. the wall clock as written, so no result depends on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ISO shapes without a zone: date, or date and time down to fractions of a second.
NAIVE_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
NAIVE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$"
BASIC_DATE = r"^[0-9]{8}$"
ZONED_TIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})$"
)
EPOCH_SECONDS = r"^[0-9]{9,10}([.][0-9]+)?$"
EPOCH_MILLIS = r"^[0-9]{12,13}$"


def naive_iso_time(text: Column) -> Column:
    """TIMESTAMP_NTZ of a zone-less ISO date or time; NULL for every other text."""
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return (
        F.when(text.rlike(NAIVE_DATE) | text.rlike(NAIVE_TIME), text.try_cast("timestamp_ntz"))
        .when(text.rlike(BASIC_DATE), dashed.try_cast("timestamp_ntz"))
    )


def _utc(instant: Column) -> Column:
    """The UTC wall clock of an instant."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def review_instant(text: Column) -> Column:
    """As ``naive_iso_time``, and also epoch seconds, epoch milliseconds and zoned times, in UTC."""
    epoch = F.when(text.rlike(EPOCH_SECONDS), text.try_cast("double")).when(
        text.rlike(EPOCH_MILLIS), text.try_cast("double") / 1000
    )
    zoned = F.when(text.rlike(ZONED_TIME), text.try_cast("timestamp"))
    return F.coalesce(naive_iso_time(text), _utc(F.timestamp_seconds(epoch)), _utc(zoned))


def format_ts_text(text: Column, missing: str = "") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (UTC) of a text that is an epoch number; any other text as it is."""
    epoch = F.when(text.rlike(EPOCH_SECONDS), text.try_cast("double")).when(
        text.rlike(EPOCH_MILLIS), text.try_cast("double") / 1000
    )
    shown = F.date_format(_utc(F.timestamp_seconds(epoch)), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(shown, text, F.lit(missing))


def format_ts(value: Column, missing: str = "", epoch: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an epoch number (``epoch``) or of a timestamp column."""
    instant = F.timestamp_seconds(value) if epoch else value
    return F.coalesce(F.date_format(instant, "yyyy-MM-dd HH:mm:ss"), F.lit(missing))
