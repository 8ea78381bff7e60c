"""Regional calendar, period arithmetic and period labels, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROC_OFFSET = 1911


def roc_month(year: Column, month: Column) -> Column:
    """Republic-of-China year and month to the first day of that month; bad input to null."""
    return F.try_to_date(
        F.format_string("%04d-%02d-01", year.cast("int") + ROC_OFFSET, month.cast("int")), "yyyy-MM-dd"
    )


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "MM")


def quarter_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "quarter")


def prior_month(c: Column) -> Column:
    return F.add_months(F.trunc(c, "MM"), -1)


def prior_year_end(c: Column) -> Column:
    """First day of December of the year before."""
    return F.add_months(F.trunc(c, "year"), -1)


def month_index(c: Column) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(c) * 12 + F.month(c)


def id_date(c: Column) -> Column:
    """Date in the first eight digits of an id, null where they are none."""
    return F.try_to_date(F.substring(c.cast("string"), 1, 8), "yyyyMMdd")


# Parts of a year that a frequency divides it into, and how a period of it is labelled.
PARTS_OF_YEAR = {"A": 1.0, "Q": 4.0, "M": 12.0, "D": 365.25}
LABELS = {"A": "yyyy", "M": "MMM-yy", "D": "d-MMM-yy"}


def axis_position(day: Column, freq: str) -> Column:
    """Place of a date's period on an axis of years."""
    part = {"A": F.lit(1), "Q": F.quarter(day), "M": F.month(day), "D": F.dayofyear(day)}[freq]
    return F.year(day) + (part - 1) / F.lit(PARTS_OF_YEAR[freq])


def period_label(day: Column, freq: str) -> Column:
    """Label of a date's period: 2024, 2Q24, Mar-24, 5-Mar-24."""
    if freq == "Q":
        return F.concat(F.quarter(day).cast("string"), F.lit("Q"), F.date_format(day, "yy"))
    return F.date_format(day, LABELS[freq])
