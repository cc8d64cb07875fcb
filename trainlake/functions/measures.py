"""Number rules that never throw under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(value: Column, sql_type: str = "bigint") -> Column:
    """Truncate to an integer type; NaN and overflow give NULL, not an error."""
    return value.try_cast(sql_type)


def not_negative(value: Column) -> Column:
    """NULL and negative values become 0."""
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, one decimal; NULL for a zero or NULL whole."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.round(ratio * 100, 1)


def pct_change(new: Column, old: Column) -> Column:
    """Change from ``old`` to ``new`` in percent; NULL unless ``old`` is positive."""
    return F.when(old > 0, percent(new - old, old))
