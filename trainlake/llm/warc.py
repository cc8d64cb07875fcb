"""WARC records, and a fixity audit of replicas by Merkle trees over offset ranges.

A volume's records are hashed with their offsets and lengths.  A leaf covers ``BLOCK`` bytes
of offsets (the records that start there), an inner node ``FAN`` ordered children, the root
the volume.  Replicas are compared from the roots down: each level joins only the children of
nodes that differ, so work after the hashing follows the damage, not the volume.  DataFrame
functions throughout.
"""

import gzip
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trainlake.llm.common import cut

VOLUME, BLOCK, FAN, LEVELS = 1000, 64 << 10, 8, 5


def record_text(url: Column, html: Column) -> Column:
    """A response record: NULL html is an empty block, NULL url leaves its header out."""
    block = F.coalesce(html, F.lit(""))
    uri = F.when(url.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n"))).otherwise("")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\n"), uri, F.lit("Content-Type: text/html\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, block, F.lit("\r\n\r\n"))


def records(pages: DataFrame, volume: int = VOLUME) -> DataFrame:
    """``volume, record_id, body``: pages as records, ``volume`` ids to a volume; those without an id in volume -1."""
    body = record_text(F.col("url").cast("string"), F.col("html").cast("string"))
    return pages.select(F.coalesce(F.floor(F.col("page_id") / volume), F.lit(-1)).cast("long").alias("volume"), F.col("page_id").cast("long").alias("record_id"), body.alias("body"))


def manifest(bodies: DataFrame) -> DataFrame:
    """``volume, record_id, copy, offset, length, digest``: records laid out by id, equal ids by digest and numbered."""
    hashed = bodies.select("volume", "record_id", F.octet_length("body").cast("long").alias("length"), F.sha2("body", 256).alias("digest"))
    order = Window.partitionBy("volume").orderBy("record_id", "digest")
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    copy = F.row_number().over(Window.partitionBy("volume", "record_id").orderBy("digest")) - 1
    return hashed.select("volume", "record_id", copy.alias("copy"), offset.alias("offset"), "length", "digest")


def _levels(rows: DataFrame) -> list[DataFrame]:
    """Nodes ``volume, node, hash`` from the leaves up to one root a volume."""
    entry = F.struct("offset", "length", "digest")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.concat_ws(":", e["offset"].cast("string"), e["length"].cast("string"), e["digest"])), ";")
    nodes = [cut(rows.groupBy("volume", F.floor(F.col("offset") / BLOCK).cast("long").alias("node")).agg(F.sha2(text, 256).alias("hash")))]
    for level in range(1, LEVELS + 1):
        above = F.floor(F.col("node") / FAN).cast("long") if level < LEVELS else F.lit(0).cast("long")
        text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node", "hash"))), lambda e: F.concat_ws(":", e["node"].cast("string"), e["hash"])), ";")
        nodes.append(nodes[-1].groupBy("volume", above.alias("above")).agg(F.sha2(text, 256).alias("hash")).withColumnRenamed("above", "node"))
    return nodes


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records of two manifests that don't agree: ``volume, record_id, copy, offset, length, state``.

    State: ``corrupt`` (other digest), ``missing`` in the replica, ``extra`` there, or ``moved`` (same digest
    at another offset).  Offset and length are the primary's, or the replica's for extra records.
    """
    mine, theirs = cut(primary), cut(replica)
    differing = None
    ours, others = _levels(mine), _levels(theirs)
    for level in range(LEVELS, -1, -1):
        a, b = ours[level], others[level]
        if differing is not None:
            above = F.floor(F.col("node") / FAN).cast("long") if level < LEVELS - 1 else F.lit(0).cast("long")
            parents = differing.select("volume", F.col("node").alias("above"))
            a, b = (x.withColumn("above", above).join(parents, ["volume", "above"], "left_semi").drop("above") for x in (a, b))
        both = a.join(b.withColumnRenamed("hash", "other"), ["volume", "node"], "full")
        differing = cut(both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("volume", "node"))
    block = F.floor(F.col("offset") / BLOCK).cast("long")
    # a record may have moved into a block that agrees in neither replica, so both sides come from differing blocks only
    a, b = (x.withColumn("node", block).join(differing, ["volume", "node"], "left_semi").drop("node") for x in (mine, theirs))
    b = b.select("volume", F.col("record_id").alias("id"), F.col("copy").alias("nth"), F.col("offset").alias("there"), F.col("length").alias("size"), F.col("digest").alias("other"))
    a, b = a.withColumn("volume_a", F.col("volume")).drop("volume"), b
    met = a.join(b, (F.col("volume_a") == F.col("volume")) & F.col("record_id").eqNullSafe(F.col("id")) & (F.col("copy") == F.col("nth")), "full")
    state = F.when(F.col("other").isNull(), "missing").when(F.col("digest").isNull(), "extra").when(F.col("digest") != F.col("other"), "corrupt").when(F.col("offset") != F.col("there"), "moved")
    return met.select(
        F.coalesce("volume_a", "volume").alias("volume"), F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("record_id")).alias("record_id"),
        F.coalesce("copy", "nth").alias("copy"), F.coalesce("offset", "there").alias("offset"), F.coalesce("length", "size").alias("length"), state.alias("state"),
    ).where("state is not null")


# --- reading files ----------------------------------------------------------------------------


def parse(data: bytes):
    """(offset, headers, block) of each record of an uncompressed or gzipped WARC file; a torn last record is left out."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data))
    at = 0
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            at += len(line)
            continue
        start, headers = at, {}
        at += len(line)
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            at += len(line)
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        at += len(line)
        size = int(headers.get("content-length", "0"))
        block = stream.read(size)
        if len(block) < size:
            return
        at += size
        yield start, headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, type, url, block`` of all records below a path; one file is one task's work."""

    def run(batches):
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = [(file, at, h.get("warc-type"), h.get("warc-target-uri"), block) for at, h, block in parse(data)]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "offset", "type", "url", "block"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file STRING, offset LONG, type STRING, url STRING, block BINARY")
