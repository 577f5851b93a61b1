"""Date keys and calendar attributes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of


def date_key(c: str | Column) -> Column:
    """Date or timestamp → ``yyyyMMdd`` integer (arithmetic, no string format)."""
    d = F.to_date(col_of(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_parts(c: str | Column) -> dict[str, Column]:
    """Calendar attributes of a date (ISO week, English month/day names)."""
    d = F.to_date(col_of(c))
    return {
        "day_of_week": F.date_format(d, "EEEE"),
        "month_of_year": F.date_format(d, "MMMM"),
        "month_of_year_number": F.month(d).cast("int"),
        "day_of_month": F.dayofmonth(d).cast("int"),
        "year": F.year(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "week_of_year": F.weekofyear(d).cast("int"),
    }


def date_description(c: str | Column) -> Column:
    """``Friday, 23 March 2018``."""
    return F.date_format(F.to_date(col_of(c)), "EEEE, d MMMM yyyy")


def day_series(start: str | Column, stop: str | Column) -> Column:
    """One element per day, both bounds inclusive (explode it)."""
    return F.explode(F.sequence(F.to_date(col_of(start)), F.to_date(col_of(stop)),
                                F.expr("INTERVAL 1 DAY")))


def add_years(start: str | Column, years: int | Column) -> Column:
    """``start + INTERVAL '1 year' * n`` (Feb 29 clamps to Feb 28)."""
    n = years if isinstance(years, Column) else F.lit(years)
    return F.add_months(F.to_date(col_of(start)), n * 12)
