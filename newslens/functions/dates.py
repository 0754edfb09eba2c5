"""Date expressions. Results are wall-clock times (TIMESTAMP_NTZ), whatever the session zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_STAMP = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}(:\d{1,2})?)?$"
_WEEKDAY = r"(?i)^(mon|tues|wednes|thurs|fri|satur|sun)day,\s+"


def stamp(text: Column, need_time: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, ``yyyy-MM-dd HH:mm`` and, unless a time is needed,
    ``yyyy-MM-dd``; null for anything else."""
    shape = _STAMP.replace(")?$", ")$") if need_time else _STAMP
    return F.when(text.rlike(shape), text.try_cast("timestamp_ntz"))


def full_month_date(text: Column) -> Column:
    """``December 5, 2025``."""
    return F.try_to_date(F.regexp_replace(text, r"\s+", " "), "MMMM d, yyyy").cast("timestamp_ntz")


def long_date(text: Column) -> Column:
    """``December 5, 2025`` or ``Dec 5, 2025``, a leading weekday ignored."""
    plain = F.regexp_replace(F.regexp_replace(text, _WEEKDAY, ""), r"\s+", " ")
    short = F.try_to_date(plain, "MMM d, yyyy").cast("timestamp_ntz")
    return F.coalesce(full_month_date(plain), short)


def lenient(text: Column) -> Column:
    """Every date form the sites emit; null where none fits."""
    cleaned = F.trim(text)
    return F.coalesce(stamp(F.translate(cleaned, "T", " ")), long_date(cleaned))


def after_label(text: Column, label: str = "Published at :") -> Column:
    """The part behind the last label, its spaces evened out."""
    return F.trim(F.regexp_replace(F.substring_index(text, label, -1), r"\s+", " "))


def after_colon(text: Column) -> Column:
    """The part behind the first colon; the whole text where there is none."""
    return F.trim(F.regexp_replace(text, r"^[^:]*:\s*", ""))


def wall_time(date: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; formatting by pattern would go through the session's zone."""
    return F.substring(date.cast("string"), 1, 19)


def moment(as_of: dt.datetime | str | Column | None) -> Column:
    """``as_of`` as a column; the driver's wall-clock time where none is given.

    That time is fixed when the plan is built, so that all steps of a job agree on it.
    """
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of or dt.datetime.now())).cast("timestamp_ntz")


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))
