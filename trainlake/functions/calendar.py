from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text to DATE; anything else is NULL instead of an error."""
    return F.try_to_date(text, "yyyy-MM-dd")


def weekday_index(day: Column, legacy: bool = False) -> Column:
    """0 = Monday … 6 = Sunday.

    ``legacy=True`` numbers Sunday -1, as tables written by older jobs do.
    """
    return F.dayofweek(day) - 2 if legacy else F.weekday(day)


def is_weekend(day: Column, legacy: bool = False) -> Column:
    """Saturday or Sunday (with ``legacy=True``: Saturday only)."""
    return weekday_index(day, legacy).isin(5, 6)


def year_text(period: Column) -> Column:
    """``2024`` out of ``2024-03``, kept as text."""
    return F.substring(period, 1, 4)


def month_text(period: Column) -> Column:
    """``03`` out of ``2024-03``, kept as text."""
    return F.substring(period, 6, 2)
