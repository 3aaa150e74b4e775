"""Timestamp expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

MICROS = 1_000_000
DAY_SECONDS = 86_400


def epoch_wrapper_to_timestamp(column: Column) -> Column:
    """``/Date(1604188800123)/`` -> timestamp, cut to whole seconds; a zone offset after the number is no part of it."""
    millis = F.regexp_extract(column, r"\(\s*(-?\d+)", 1)
    return F.date_trunc("second", F.timestamp_millis(millis.try_cast("bigint")))


def lenient_day_first(date: Column, time: Column) -> Column:
    """Date and time texts -> timestamp; anything unreadable -> NULL.

    Dates have their day first, or their year if it has four digits; parts are separated by slashes,
    hyphens or dots.  The time may lack its seconds, or all of it, and may have a fraction.  All spellings
    are brought into one, which is parsed once: the generated code stays small.
    """
    day = F.regexp_replace(F.trim(date), r"[-./]", "/")
    day = F.regexp_replace(day, r"^(\d{1,2})/(\d{1,2})/(\d{2})$", "$1/$2/20$3")
    day = F.regexp_replace(day, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3/$2/$1")
    clock = F.coalesce(F.nullif(F.trim(time), F.lit("")), F.lit("0:00:00"))
    clock = F.regexp_replace(clock, r"^(\d{1,2}:\d{2})$", "$1:00")
    # The fraction, in microseconds, stands behind the seconds; more digits are cut off.
    clock = F.regexp_replace(F.concat(clock, F.lit("|000000")), r"^([^.|]*)\.?(\d{0,6})\d*\|(\d*)$", "$1.$2$3")
    text = F.regexp_extract(
        F.concat_ws(" ", day, clock), r"^(\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}\.\d{6})\d*$", 1)
    return F.try_to_timestamp(text, F.lit("yyyy/M/d H:mm:ss.SSSSSS"))


def iso_timestamp(column: Column) -> Column:
    """ISO-8601 with zone and up to nanoseconds (cut to microseconds); bad text -> NULL."""
    return column.try_cast("timestamp")


def plain_timestamp(column: Column, zone: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, read as UTC or as wall time of ``zone``."""
    # Texts of this form mean the same in a cast, which takes a fifth of the time; others are left to the pattern.
    cast = F.when(column.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"), column.try_cast("timestamp"))
    parsed = F.coalesce(cast, F.try_to_timestamp(column, F.lit("yyyy-MM-dd HH:mm:ss")))
    return parsed if zone is None else F.to_utc_timestamp(parsed, zone)


def offset_timestamp(column: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` with ``+01:00`` or ``+0100``."""
    return F.coalesce(
        column.try_cast("timestamp"),
        F.try_to_timestamp(column, F.lit("yyyy-MM-dd'T'HH:mm:ssXX")),
    )


def day_text(column: Column, pattern: str = "yyyy/MM/dd") -> Column:
    return F.date_format(column, pattern)


def seconds_of(period: str | int) -> int:
    """``'10min'``, ``'60 minutes'`` or a number of seconds -> seconds."""
    exact = period if isinstance(period, int) else pd.Timedelta(period).total_seconds()
    if exact < 1 or exact != int(exact):
        raise ValueError(f"period must be whole seconds: {period!r}")
    return int(exact)
