from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_json(raw: DataFrame, wire: str, *keep: str, column: str = "json_str") -> DataFrame:
    """The fields of a JSON text column as columns, typed by the DDL text ``wire``.

    ``inline(array(from_json(…)))`` instead of a plain projection: later filters
    on the fields cannot be pushed below the generator, where Catalyst would
    repeat ``from_json`` once per predicate.  Each record is parsed once.  Columns
    named in ``keep`` are passed through in front.
    """
    record = F.from_json(column, wire)
    return raw.select(*keep, F.inline(F.array(record)))
