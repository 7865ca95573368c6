"""Column expressions shared by the jobs. Everything here stays inside code generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_bounds(month: str) -> tuple[dt.date, dt.date]:
    """First day of ``YYYY-MM`` and of the month after it."""
    first = dt.datetime.strptime(month, "%Y-%m").date()
    return first, (first + dt.timedelta(days=31)).replace(day=1)


def _ntz(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def _between(df: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Half-open range on the bare column, so that both bounds reach the file scan."""
    kind = df.schema[column].dataType.typeName()
    edge = F.lit if kind == "date" else _ntz
    return df.filter((F.col(column) >= edge(start)) & (F.col(column) < edge(end)))


def in_month(df: DataFrame, column: str, month: str | None) -> DataFrame:
    """Rows of one month; ``None`` keeps all of them."""
    return df if month is None else _between(df, column, *month_bounds(month))


def in_day(df: DataFrame, column: str, day: str | dt.date | None) -> DataFrame:
    """Rows of one day; ``None`` keeps all of them."""
    if day is None:
        return df
    start = dt.date.fromisoformat(str(day))
    return _between(df, column, start, start + dt.timedelta(days=1))


def month_text(column: str | Column) -> Column:
    """``YYYY-MM`` of a date or timestamp."""
    return F.date_format(column, "yyyy-MM")


def previous_month(column: str | Column) -> Column:
    """``YYYY-MM`` of the calendar month before."""
    return F.date_format(F.add_months(F.to_date(column), -1), "yyyy-MM")


def leading_int(column: str | Column) -> Column:
    """Unsigned integer read from the digits a text starts with; 0 without any, null for null."""
    text = F.col(column) if isinstance(column, str) else column
    digits = F.regexp_extract(text, r"^\s*(\d+)", 1)
    return F.when(text.isNotNull(), F.coalesce(digits.try_cast("int"), F.lit(0)))


def age_band(birth_year: str, as_of_year: int) -> Column:
    return F.floor((F.lit(as_of_year) - F.col(birth_year)) / 10)


def decimal_score(value: Column) -> Column:
    """Two-digit score; what does not fit becomes null instead of failing the job."""
    return value.try_cast("decimal(3,2)")


def mean_from(total: Column, n: Column) -> Column:
    """Mean out of pre-aggregated sums; null when nothing was counted."""
    return F.try_divide(F.sum(total), F.sum(n))


def date_or_epoch(column: str | Column) -> Column:
    """Date read from text, or 1970-01-01 when it cannot be read."""
    text = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.try_to_timestamp(text.cast("string")).cast("date"), F.lit(dt.date(1970, 1, 1)))


def number_text(value: Column, digits: int = 9) -> Column:
    """Whole numbers without a point, others rounded."""
    whole = value == F.floor(value)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(F.round(value, digits).cast("string"))
