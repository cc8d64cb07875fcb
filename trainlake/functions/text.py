from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(name: Column) -> Column:
    """First letter of each space-separated word upper, the rest lower."""
    return F.initcap(name)


def name_key(name: Column) -> Column:
    """A station name as a join key: case and runs of blanks don't count; blank names are NULL."""
    return F.nullif(F.upper(F.trim(F.regexp_replace(name, r"\s+", " "))), F.lit(""))


def od_pair(origin: Column, destination: Column) -> Column:
    """``origin->destination``; NULL if either end is NULL."""
    return F.concat(origin, F.lit("->"), destination)
