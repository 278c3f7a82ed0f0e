"""Time as columns. Timestamps have no zone; today is always a parameter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000


def parse_timestamp(text: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss as a timestamp without zone."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def whole_days(start: Column, end: Column) -> Column:
    """Full days of 24 hours between two timestamps, rounded down also below zero."""
    return F.floor(F.timestamp_diff("MICROSECOND", start, end) / F.lit(DAY)).cast("int")


def epoch_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def parse_date(text: Column) -> Column:
    """Date of an ISO date or a yyyy-MM-ddTHH:mm:ss.fZ timestamp; null for null, 'Present' and anything else."""
    shaped = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?Z?)?$"), F.substring(text, 1, 10))
    return shaped.try_cast("date")


def is_present(text: Column) -> Column:
    return F.coalesce(text == "Present", F.lit(False))


def unreadable(text: Column) -> Column:
    return text.isNotNull() & ~is_present(text) & parse_date(text).isNull()


def availability(text: Column, strict: bool = False) -> Column:
    """struct<start,end> of a 'start - end' text with exactly one separator, else null.

    strict also asks that both be dates, the end possibly 'Present'.
    """
    parts = F.split(text, " - ")
    good = F.size(parts) == 2
    if strict:
        good = good & parse_date(F.get(parts, 0)).isNotNull() & (parse_date(F.get(parts, 1)).isNotNull() | is_present(F.get(parts, 1)))
    return F.when(good, F.struct(F.get(parts, 0).alias("start"), F.get(parts, 1).alias("end")))


def period_start(end: Column, months: int, earliest: Column, current: Column) -> Column:
    """months before end, clipped to the month's end; current where that lies before earliest."""
    new = F.add_months(end, -months)
    return F.when(new >= earliest, new).otherwise(current)


def year_start(today: date) -> Column:
    return F.trunc(F.lit(today), "YEAR")
