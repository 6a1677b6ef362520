"""Text dates and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text date layout of the source tables (month/day/year, no zero padding).
SOURCE_DATE_FORMAT = "M/d/yyyy"

CALENDAR_PARTS = ("day", "month", "quarter", "year")


def parse_date(c: Column | str, fmt: str = SOURCE_DATE_FORMAT) -> Column:
    """Text -> date; text that does not match ``fmt`` gives null (never fails the job)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col, fmt)


def date_text(c: Column | str) -> Column:
    """Date -> ``M/d/yyyy`` text (inverse of ``parse_date``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, SOURCE_DATE_FORMAT)


def calendar_columns(date_col: str, suffix: str = "", names: dict[str, str] | None = None) -> dict[str, Column]:
    """``{day<suffix>, month<suffix>, quarter<suffix>, year<suffix>}`` from one date column."""
    d = F.col(date_col)
    exprs = {
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
    }
    names = names or {}
    return {names.get(part, f"{part}{suffix}"): expr for part, expr in exprs.items()}


def add_calendar(df: DataFrame, date_col: str, suffix: str = "", names: dict[str, str] | None = None) -> DataFrame:
    """Add the four calendar parts in one projection."""
    return df.withColumns(calendar_columns(date_col, suffix, names))


def parse_and_add_calendar(df: DataFrame, date_col: str, suffix: str = "", fmt: str = SOURCE_DATE_FORMAT) -> DataFrame:
    """Parse ``date_col`` in place, then add its calendar parts."""
    return add_calendar(df.withColumn(date_col, parse_date(date_col, fmt)), date_col, suffix)


__all__ = [
    "CALENDAR_PARTS",
    "SOURCE_DATE_FORMAT",
    "add_calendar",
    "calendar_columns",
    "date_text",
    "parse_and_add_calendar",
    "parse_date",
]
