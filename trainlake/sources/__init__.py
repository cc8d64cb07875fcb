from trainlake.sources.pages import declared_totals, read_pages, unreadable_pages
from trainlake.sources.raw import kafka_source, kafka_sources, text_batch, text_source
from trainlake.sources.tables import Table, read_silver, read_static

__all__ = [
    "Table",
    "declared_totals",
    "kafka_source",
    "kafka_sources",
    "read_pages",
    "read_silver",
    "read_static",
    "text_batch",
    "text_source",
    "unreadable_pages",
]
