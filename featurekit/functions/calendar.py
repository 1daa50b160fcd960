"""Column expressions on event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 24 * 3600


def offset_timestamp(seconds: Column, start: str = "2017-12-01") -> Column:
    """Timestamp (without zone) that lies the given number of seconds after ``start``."""
    return F.timestamp_add("SECOND", seconds.cast("bigint"), F.lit(start).cast("timestamp_ntz"))


def seconds_since(moment: Column, start: str) -> Column:
    """Whole seconds between ``start`` and a timestamp, independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.lit(start).cast("timestamp_ntz"), moment.cast("timestamp_ntz"))


def offset_weekday(seconds: Column) -> Column:
    """Day-of-week number 0..6 of an offset; the first day counts as 6."""
    return F.floor(F.pmod(seconds / F.lit(DAY_SECONDS) - F.lit(1.0), F.lit(7.0)))


def offset_hour(seconds: Column) -> Column:
    return F.pmod(F.floor(seconds / F.lit(3600)), F.lit(24))


def parts(moment: Column) -> dict[str, Column]:
    """Year, month, weekday (Monday = 0), quarter, hour and day of month."""
    return {
        "year": F.year(moment),
        "month": F.month(moment),
        "dow": F.weekday(moment),
        "quarter": F.quarter(moment),
        "hour": F.hour(moment),
        "day": F.dayofmonth(moment),
    }


def month_code(moment: Column) -> Column:
    """201712 for December 2017."""
    return F.year(moment) * 100 + F.month(moment)


def day_code(moment: Column) -> Column:
    """20171231 for the last day of 2017."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def month_number(moment: Column, base_year: int = 2017) -> Column:
    """Consecutive month number; month 12 is December of ``base_year``."""
    return (F.year(moment) - base_year) * 12 + F.month(moment)
