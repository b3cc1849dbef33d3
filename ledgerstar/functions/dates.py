"""Date parsing and calendar attributes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Polish calendar labels, without diacritics; days start on Sunday.
DAY_NAMES_PL = [
    "niedziela", "poniedzialek", "wtorek", "sroda", "czwartek", "piatek", "sobota",
]
MONTH_NAMES_PL = [
    "styczen", "luty", "marzec", "kwiecien", "maj", "czerwiec",
    "lipiec", "sierpien", "wrzesien", "pazdziernik", "listopad", "grudzien",
]


def parse_date(c: Column) -> Column:
    """ISO dates and timestamps, else month/day/year; anything else is null.

    The timestamp cast decides whether the text is valid (a date cast alone would
    accept any tail after the day); the date cast keeps the written calendar day.
    """
    iso = F.when(c.try_cast("timestamp_ntz").isNotNull(), c.try_cast("date"))
    return F.coalesce(iso, F.try_to_date(F.trim(c), "M/d/yyyy"))


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_of(key: Column) -> Column:
    """yyyymm of a yyyymmdd integer."""
    return F.floor(key / 100).cast("int")


def period_columns(month: Column) -> dict[str, Column]:
    """The calendar's period columns from a yyyymm integer."""
    number = (month % 100).cast("int")
    year = F.floor(month / 100).cast("int")
    return {
        "year": year,
        "quarter": F.ceil(number / 3).cast("int"),
        "month": number,
        "year_month": F.concat(
            F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(number.cast("string"), 2, "0")
        ),
    }


def _label(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_columns(c: Column) -> list[Column]:
    """The thirteen dim_date columns; day_of_week counts from 1 = Sunday."""
    weekday = F.dayofweek(c)
    return [
        date_key(c).alias("date_key"),
        c.alias("date"),
        F.dayofmonth(c).alias("day"),
        F.month(c).alias("month"),
        F.date_format(c, "MMMM").alias("month_name_en"),
        F.quarter(c).alias("quarter"),
        F.year(c).alias("year"),
        weekday.alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_name_en"),
        _label(DAY_NAMES_PL, weekday).alias("day_name_pl"),
        weekday.isin(1, 7).cast("int").alias("is_weekend"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
        _label(MONTH_NAMES_PL, F.month(c)).alias("month_name_pl"),
    ]
