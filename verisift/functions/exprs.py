"""Small column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def ref_day(as_of: str | date | Column | None) -> Column:
    """The reference day of a calculation: a fixed date, a column, or today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def ref_instant(as_of: object) -> Column:
    """The reference instant of a calculation, defaulting to now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double precision; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def month_number(period: Column) -> Column:
    """Months since year 0 of a ``yyyy-MM`` text, so that month distances are differences."""
    year = F.substring(period, 1, 4).try_cast("int")
    month = F.substring(period, 6, 2).try_cast("int")
    return year * 12 + month


def share(condition: Column) -> Column:
    """1.0 where the condition holds, else 0.0 (NULL counts as not holding)."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def data_columns(columns: list[str]) -> list[str]:
    """Columns that carry data: protocol columns start with an underscore."""
    return [c for c in columns if not c.startswith("_")]
