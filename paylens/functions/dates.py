"""Dates: strict parsing, repairs and boundary-counting differences."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

INVALID_DATE = "INVALID_DATE"
EPOCH = "1970-01-01 00:00:00"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
DAY_FIRST_DATE = r"^\d{2}-\d{2}-\d{4}$"


def strict_date(text: Column) -> Column:
    """ISO date or null; never raises under ANSI mode."""
    return F.when(text.rlike(ISO_DATE), F.try_to_date(text, "yyyy-MM-dd"))


def mark_bad_date(text: Column) -> Column:
    """Keep good dates and nulls, replace anything unparsable by a marker."""
    return F.when(text.isNotNull() & strict_date(text).isNull(), INVALID_DATE).otherwise(text)


def iso_from_day_first(text: Column) -> Column:
    """DD-MM-YYYY becomes YYYY-MM-DD; every other shape stays as it is."""
    swapped = F.regexp_replace(text, r"^(\d{2})-(\d{2})-(\d{4})$", "$3-$2-$1")
    return F.when(text.rlike(DAY_FIRST_DATE), swapped).otherwise(text)


def years_between(start: Column, end: Column) -> Column:
    """Year boundaries crossed, as warehouse DATEDIFF('year') counts them."""
    return F.year(end) - F.year(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, as warehouse DATEDIFF('minute') counts them."""
    return F.floor(epoch(end) / 60).cast("long") - F.floor(epoch(start) / 60).cast("long")


def wall_clock(at: datetime.datetime | str) -> Column:
    """A literal without time zone; a plain datetime literal would be shifted to the session's zone."""
    return F.lit(str(at)).cast("timestamp_ntz")


def epoch(ts: Column) -> Column:
    """Whole seconds of the wall clock since 1970, whatever the session's time zone."""
    passed = ts.cast("timestamp_ntz") - wall_clock(EPOCH)
    return F.floor(passed.cast("interval second").cast("decimal(20,6)")).cast("long")


def hour_label(ts: Column) -> Column:
    return F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd HH:mm")


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket, as epoch seconds."""
    return F.floor(epoch(ts) / seconds).cast("long") * seconds


def epoch_label(seconds: Column) -> Column:
    at = wall_clock(EPOCH) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")
