"""Dates, ages and the reference day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_AGE_YEARS = 16

# Free-form dates: month first or day first, the month known by its first three letters.
_MONTH_FIRST = r"^([A-Z][a-z]{2})[a-z]*\.? (\d{1,2}),? (\d{4})$"
_DAY_FIRST = r"^(\d{1,2}) ([A-Z][a-z]{2})[a-z]*\.?,? (\d{4})$"
_MONTH_ONLY = r"^([A-Z][a-z]{2})[a-z]*\.?,? (\d{4})$"
# What may stand before and after a free-form date: a weekday, and a time of day with its zone.
_WEEKDAY = r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,? +"
_TIME = r"(?i),? +\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[ap]m)?( ?(z|utc|gmt)?([+-]\d{2}:?\d{2})?)?( \(.*\))?$"


def day(as_of: Column | dt.date | str | None) -> Column:
    """The reference day: a literal, a column, or today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def _full_years(later: Column, earlier: Column) -> Column:
    short_of_birthday = (F.month(later) * 100 + F.dayofmonth(later)) < (F.month(earlier) * 100 + F.dayofmonth(earlier))
    return F.year(later) - F.year(earlier) - short_of_birthday.cast("int")


def age_in_years(born: Column, as_of=None) -> Column:
    """Completed calendar years, truncated towards zero for a birth date in the future.

    ``months_between`` is not used: it calls 29 February to 28 February a whole year.
    """
    on = day(as_of)
    return F.when(born > on, -_full_years(born, on)).otherwise(_full_years(on, born))


def age_by_days(born: Column, as_of=None) -> Column:
    """Age by the 365.25-day year, as the sheet-side rules count it."""
    return F.floor(F.datediff(day(as_of), born) / F.lit(365.25)).cast("int")


def latest_birth_date(as_of=None, years: int = MIN_AGE_YEARS) -> Column:
    return F.add_months(day(as_of), -12 * years)


def old_enough(born: Column, as_of=None, years: int = MIN_AGE_YEARS) -> Column:
    return born <= latest_birth_date(as_of, years)


def parse_date(text: Column) -> Column:
    """ISO (a time part may follow), day-first ``D/M/YYYY``, or a free-form date; else NULL.

    Free-form dates may have a weekday before and a time after them: ``Y-M-D`` and ``Y/M/D`` without leading zeros,
    month-first ``M-D-Y`` (with a time also ``M/D/Y``), a written month before or after the day, or a written month and year
    alone, which is its first day. Impossible dates are NULL, and the written calendar day is kept whatever the time zone.
    """
    from rosterline.functions.cleaning import trim_text

    def shaped(value: Column, pattern: str, group: int = 1) -> Column:
        """The value where it has the shape, else NULL: a failed parse costs far more than a match."""
        return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))

    clean = trim_text(text)
    bare = F.regexp_replace(F.regexp_replace(clean, _WEEKDAY, ""), _TIME, "")
    worded = F.regexp_replace(F.initcap(bare), _DAY_FIRST, "$2 $1 $3")
    worded = F.regexp_replace(worded, _MONTH_FIRST, "$1 $2 $3")
    worded = F.regexp_replace(worded, _MONTH_ONLY, "$1 1 $2")
    timed = F.when(bare != clean, bare)
    return F.coalesce(
        F.try_to_date(shaped(clean, r"^(\d{4}-\d{2}-\d{2})(T.*|\s+\d.*)?$"), "yyyy-MM-dd"),
        F.try_to_date(shaped(clean, r"^(\d{1,2}/\d{1,2}/\d{4})$"), "d/M/yyyy"),
        F.try_to_date(shaped(bare, r"^(\d{4}/\d{1,2}/\d{1,2})$"), "yyyy/M/d"),
        F.try_to_date(shaped(bare, r"^(\d{4}-\d{1,2}-\d{1,2})$"), "yyyy-M-d"),
        F.try_to_date(shaped(bare, r"^(\d{1,2}-\d{1,2}-\d{4})$"), "M-d-yyyy"),
        F.try_to_date(shaped(timed, r"^(\d{1,2}/\d{1,2}/\d{4})$"), "M/d/yyyy"),
        F.try_to_date(shaped(worded, r"^([A-Z][a-z]{2} \d{1,2} \d{4})$"), "MMM d yyyy"),
    )
