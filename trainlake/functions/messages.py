from pyspark.sql import Column
from pyspark.sql import functions as F


def message_key(*fields: Column) -> Column:
    """Fields joined with ``_`` (NULL counts as empty text); an empty key is NULL."""
    texts = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return F.nullif(F.concat_ws("_", *texts), F.lit(""))


def ingest_stamp(at: Column | None = None) -> Column:
    """UTC stamp such as ``2024-01-07T08:00:00Z``, whatever the session time zone."""
    moment = F.current_timestamp() if at is None else at
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
