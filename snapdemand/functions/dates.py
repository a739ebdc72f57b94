"""Dates out of mixed notations; none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapdemand.functions.regex import squeeze
from snapdemand.functions.text import trim_zs

_PER_DAY = {"s": 86_400, "ms": 86_400_000}


def to_day(text: Column) -> Column:
    """A date, null when the text is none."""
    return text.try_cast("date")


def epoch_date(number: Column, unit: str) -> Column:
    """The UTC day of an epoch number in seconds ('s') or milliseconds ('ms')."""
    return F.date_from_unix_date(F.floor(number / F.lit(_PER_DAY[unit])).cast("int"))


def epoch_text(number: Column, unit: str) -> Column:
    """The UTC day as ISO text; '' for null and 0."""
    return F.when(number != 0, epoch_date(number, unit).cast("string")).otherwise("")


def parse_when(raw: Column, observed: Column) -> Column:
    """The day meant by ``raw``; relative notations count back from the day ``observed``. Null for anything else."""
    word = F.lower(trim_zs(raw))
    days_back = F.regexp_extract(raw, "[0-9]+", 0).try_cast("int")
    long_month = F.try_to_timestamp(squeeze(trim_zs(raw)), F.lit("MMMM d, yyyy")).cast("date")
    return (
        F.when(word == "posted today", observed)
        .when(word == "posted yesterday", F.date_sub(observed, 1))
        .when(raw.rlike(r"(?i)\Aposted [0-9]+\+? days? ago\z"), F.date_sub(observed, days_back))
        .when(raw.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"), to_day(F.substring(raw, 1, 10)))
        .when(raw.rlike(r"\A[0-9]{12,13}\z"), epoch_date(raw.try_cast("bigint"), "ms"))
        .when(raw.rlike(r"\A[A-Za-z]+[ \t\n\f\r]+[0-9]{1,2},[ \t\n\f\r]+[0-9]{4}\z"), long_month)
    )


def week_start(day: Column) -> Column:
    """The Monday of the day's week."""
    return F.trunc(day, "week")


def span_days(first: Column, last: Column) -> Column:
    """Days from ``first`` to ``last``, both counted."""
    return F.datediff(last, first).cast("bigint") + 1


def age_hours(at: Column, now: Column) -> Column:
    """Full hours from ``at`` to ``now``."""
    return F.timestamp_diff("HOUR", at, now)
