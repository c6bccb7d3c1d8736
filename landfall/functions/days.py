"""Day numbers (days since 1960-01-01) and calendar parts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

EPOCH = datetime.date(1960, 1, 1)


def sas_date(days: Column) -> Column:
    """Day number to date. A fraction of a day rounds down, also before 1960."""
    whole = F.floor(F.when(~F.isnan(days), days)).try_cast("int")
    return F.date_add(F.lit(EPOCH), whole)


def sas_day_of_month(days: Column) -> Column:
    return F.dayofmonth(sas_date(days))


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit(EPOCH))


def calendar_parts(date: Column) -> dict[str, Column]:
    """ISO week (1-53) and weekday 0-6 with Sunday 0, as date_part gives them."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "week": F.weekofyear(date),
        "day_of_week": F.dayofweek(date) - 1,
        "quarter": F.quarter(date),
    }


def date_of_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts; NULL where they name no real day."""
    in_calendar = year.between(1, 9999) & month.between(1, 12)
    month_end = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.when(in_calendar, F.when(day.between(1, month_end), F.make_date(year, month, day)))
