"""Date parsing, parts and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_mixed_date(text: Column) -> Column:
    """ISO first, then month-first, then day-first; null when none of them fits."""
    tidy = F.translate(F.trim(text), "/", "-")
    return F.coalesce(
        F.try_to_date(tidy, "yyyy-M-d"),
        F.try_to_date(tidy, "M-d-yyyy"),
        F.try_to_date(tidy, "d-M-yyyy"),
    )


def parse_month_first(text: Column) -> Column:
    """ISO, else month-first; null when neither fits."""
    tidy = F.translate(F.trim(text), "/", "-")
    return F.coalesce(F.try_to_date(tidy, "yyyy-M-d"), F.try_to_date(tidy, "M-d-yyyy"))


def parse_utc(text: Column) -> Column:
    """ISO text with an offset or ``Z`` -> wall-clock time in UTC, without a zone."""
    instant = F.try_to_timestamp(text).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant)


def month_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def weekday_number(moment: Column) -> Column:
    """Monday is 0."""
    return F.weekday(moment)


def weekday_name(moment: Column) -> Column:
    return F.date_format(moment, "EEE")


def month_name(moment: Column) -> Column:
    return F.date_format(moment, "MMMM")


def week_ending_sunday(moment: Column) -> Column:
    return F.date_add(F.date_trunc("week", moment).cast("date"), 6)


def date_range_text(moment: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Aggregate: 'first to last' as text."""
    return F.concat(
        F.date_format(F.min(moment), pattern), F.lit(" to "), F.date_format(F.max(moment), pattern)
    )
