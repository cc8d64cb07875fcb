"""What a stateful stream remembers: a store that outgrows memory, and a look into it."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session settings for state on the executors' disks, of which a checkpoint takes the changes only.
#: A query keeps the store it was started with.
ROCKSDB_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Blocks and buffers of all stores of an executor together; else each store, also of a query that has just ended,
    # keeps some 130 MB outside the heap.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operatorId, operatorName, numPartitions`` of the stateful steps of a query, from its checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName", "numPartitions")


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """``partition_id, key, value`` of all entries in the state of one step, as of the last committed batch."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint).select("partition_id", "key", "value")


def remembered_keys(spark: SparkSession, checkpoint: str, key: Sequence[str]) -> DataFrame:
    """``*key, partition_id, expires_at`` of the keys that a stream with ``ttl`` will not let through again.

    Of the query's steps the one counts whose state has just these keys; the step before it, which spreads hot
    keys, remembers them with their spread number.
    """
    for row in state_operators(spark, checkpoint).orderBy("operatorId").collect():  # one row a step
        rows = state_rows(spark, checkpoint, row["operatorId"])
        if set(rows.schema["key"].dataType.fieldNames()) == set(key):
            expires = F.timestamp_micros(F.col("value.expiresAtMicros")).alias("expires_at")
            return rows.select(*(f"key.{c}" for c in key), "partition_id", expires)
    raise ValueError(f"no state under {checkpoint} has the keys {', '.join(key)}")


def state_parts(keys: DataFrame) -> DataFrame:
    """``partition_id, n_keys, oldest, newest``: how the remembered keys are dealt out, and the first and last to expire."""
    return keys.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("n_keys"), F.min("expires_at").alias("oldest"), F.max("expires_at").alias("newest")
    )
