from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    """True where one of the conditions is; without conditions nowhere."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all the named columns have a value."""
    return df.where(all_of(F.col(c).isNotNull() for c in columns))


def first_rows(df: DataFrame, order: Iterable[str | Column], limit: int) -> DataFrame:
    """The first ``limit`` rows in ``order``.

    Plans as a top-k without a global sort: every task hands its first ``limit``
    rows to the last one, so this is for reports, not for cutting a table in two.
    The order should be total, else the choice is arbitrary on ties.
    """
    return df.orderBy(*order).limit(limit)
