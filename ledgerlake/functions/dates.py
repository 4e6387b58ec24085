"""Calendar arithmetic on columns: integer day keys, fiscal periods, weekday rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .columns import _col, group_map


def date_key(day: Column | str) -> Column:
    """Day as the integer YYYYMMDD."""
    d = _col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def key_to_date(key: Column | str) -> Column:
    """Day of an integer YYYYMMDD; NULL when it is no calendar day."""
    return F.try_to_timestamp(_col(key).cast("string"), F.lit("yyyyMMdd")).cast("date")


def key_year(key: Column | str) -> Column:
    return F.floor(_col(key) / 10000).cast("int")


def key_month(key: Column | str) -> Column:
    return (F.floor(_col(key) / 100) % 100).cast("int")


def month_key(key: Column | str) -> Column:
    """YYYYMM of an integer YYYYMMDD, the partition column of fact tables; 0 if unknown."""
    return F.coalesce(F.floor(_col(key) / 100).cast("int"), F.lit(0))


def month_index(day: Column | str) -> Column:
    """Months since year 0; neighbouring months differ by one."""
    d = _col(day)
    return (F.year(d) * 12 + F.month(d) - 1).cast("bigint")


def _shifted(day: Column | str) -> Column:
    return F.add_months(_col(day), 13 - fixed.FISCAL_START_MONTH)


def fiscal_year(day: Column | str) -> Column:
    return F.year(_shifted(day))


def fiscal_quarter(day: Column | str) -> Column:
    return F.quarter(_shifted(day))


def fiscal_month(day: Column | str) -> Column:
    return F.month(_shifted(day))


def fiscal_year_start(day: Column | str) -> Column:
    return F.make_date(fiscal_year(day) - 1, F.lit(fixed.FISCAL_START_MONTH), F.lit(1))


def day_of_fiscal_year(day: Column | str) -> Column:
    return F.datediff(_col(day), fiscal_year_start(day)) + 1


def fiscal_week(day: Column | str) -> Column:
    """Seven-day blocks counted from the first day of the fiscal year, from 1."""
    return F.floor((day_of_fiscal_year(day) - 1) / 7).cast("int") + 1


def season(day: Column | str) -> Column:
    return group_map(F.month(_col(day)), fixed.SEASONS)


def is_month_end(day: Column | str) -> Column:
    return _col(day) == F.last_day(_col(day))


def is_quarter_end(day: Column | str) -> Column:
    return is_month_end(day) & (F.month(_col(day)) % 3 == 0)


def nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    """The n-th (from 1) given weekday ('MON'…) of a month."""
    before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(before, weekday), 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: str) -> Column:
    """The last given weekday ('MON'…) of a month."""
    return F.next_day(F.date_sub(F.last_day(F.make_date(year, F.lit(month), F.lit(1))), 7), weekday)
