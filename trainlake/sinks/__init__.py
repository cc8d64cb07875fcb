from trainlake.sinks.messages import kafka_messages, text_messages, write_kafka
from trainlake.sinks.tables import append_lot, compact, object_store_conf, write_snapshot

__all__ = [
    "append_lot",
    "compact",
    "kafka_messages",
    "text_messages",
    "object_store_conf",
    "write_kafka",
    "write_snapshot",
]
