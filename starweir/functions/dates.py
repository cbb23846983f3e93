"""Dates that arrive as integers or text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_int_date(column: Column) -> Column:
    """``20101229`` as a date. Zero, any other number of digits, and digits that
    name no day give NULL.

    Arithmetic on the number avoids building and parsing a text per row, and the
    conditions keep values that ANSI mode refuses away from ``make_date``.
    """
    number = column.try_cast("int")
    month, day = F.floor(number / 100) % 100, number % 100
    first = F.make_date(F.floor(number / 10000), month, F.lit(1))
    return F.when(
        number.between(10_000_000, 99_999_999)
        & month.between(1, 12)
        & day.between(1, F.dayofmonth(F.last_day(first))),
        F.date_add(first, (day - 1).cast("int")),
    )


def null_future(column: Column, as_of: Column | None = None) -> Column:
    """NULL for dates after ``as_of`` (today by default), else the value as it is.

    The value may be text; text that is no date stays.
    """
    limit = F.current_date() if as_of is None else as_of
    return F.when(column.try_cast("date") > limit, F.lit(None)).otherwise(column)
