from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake.functions import ingest_stamp, message_key


def kafka_messages(records: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Records → ``(key, value)``: stamped, as JSON with NULL fields written out.

    ``key`` names the fields the key text is made of; none gives a NULL key, which
    lets the broker choose the partition.
    """
    fields = [c for c in records.columns if c != "ingested_at"]
    record = F.struct(*fields, ingest_stamp().alias("ingested_at"))
    made_of = [F.col(c) for c in key]
    return records.select(
        (message_key(*made_of) if made_of else F.lit(None).cast("string")).alias("key"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
    )


def text_messages(records: DataFrame, key: Sequence[str] = (), at: Column | None = None) -> DataFrame:
    """Records as JSON text → ``(key, value)`` with every field they came with, stamped anew.

    ``records`` has ``json_str`` and the columns of the key.  The text becomes a map of variants, so
    fields that no schema names keep their values and types, absent ones stay absent, and an older
    ``ingested_at`` is replaced.
    """
    made_of = [F.col(c) for c in key]
    fields = F.from_json("json_str", "MAP<STRING, VARIANT>")
    stamp = F.map_from_arrays(F.array(F.lit("ingested_at")), F.array(F.parse_json(F.concat(F.lit('"'), ingest_stamp(at), F.lit('"')))))
    whole = F.map_concat(F.map_filter(fields, lambda k, v: k != "ingested_at"), stamp)
    return records.select(
        (message_key(*made_of) if made_of else F.lit(None).cast("string")).alias("key"),
        F.to_json(whole).alias("value"),
    )


def write_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send ``(key, value)`` rows; the executors write, partition by partition.

    Needs the ``spark-sql-kafka-0-10`` package of the running Spark version.
    """
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
