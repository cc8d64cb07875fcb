"""Substring dedup: every window of 20 words that also starts earlier loses its words.

Pass 1 counts, in a count-min sketch, one anchor for each window: the least of the hashes of
its 11 runs of ten words.  Equal windows have equal anchors at different places, so the count
of an anchor is never below that of a window that holds it.  Pass 2 sends only windows whose
anchor is estimated repeated to an exact grouping by 128-bit keys of their words.  Within a
slice of text a key is sent once, by its earliest place; the later places are settled there and
travel by their document.  Keys are dealt out by themselves, not by their anchor, as windows over
the edge of a common passage share its anchors.  So a passage in a third of all documents costs
the bucket of each of its keys one entry a slice.
"""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trainlake.llm.common import map_arrow, mixed, rolled, slots, text_bytes, word_bounds, word_hashes
from trainlake.llm.sketch import LOG_WIDTH, counted

WINDOW, ANCHOR = 20, 10
#: Groups of keys that one shuffle partition holds, one in memory at a time.
GROUPS = 16

_KEYED = "doc LONG, mark LONG, text STRING"


def _keyed(documents: DataFrame, *keep) -> DataFrame:
    """Rows told apart by id and text; a NULL id comes before all others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long")).alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"), *keep)


def _windows(batch: pa.RecordBatch, window: int, anchor: int, which: tuple[int, ...] = (0,)):
    """(row, start word, place of the anchor, anchors, word hashes) of all windows inside rows."""
    raw, offsets = text_bytes(batch.column("text"))
    starts, ends, first = word_bounds(raw, offsets)
    hashes = [word_hashes(raw, starts, ends, k) for k in which]
    n = len(starts) - window + 1
    if n < 1:
        return None
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(n)
    at = at[row[:n] == row[window - 1 :]]
    grams = rolled(hashes[0], anchor)
    best, reach, many = np.arange(len(grams)), 1, window - anchor + 1
    while reach < many:  # the leftmost least of ``reach`` neighbours, doubled
        step = min(reach, many - reach)
        ahead = best[step:]
        best = np.where(grams[ahead] < grams[best[: len(ahead)]], ahead, best[: len(ahead)])
        reach += step
    return row[at], at - first[row[at]], best[at], grams, at, hashes


def _anchors(batch: pa.RecordBatch, window: int, anchor: int) -> np.ndarray:
    found = _windows(batch, window, anchor)
    return found[3][np.unique(found[2])] if found else np.empty(0, np.uint64)


def _packed(*arrays) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def _changes(*columns) -> np.ndarray:
    """Where sorted rows differ from the row before (the first one does)."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return new


def _by_bucket(bucket) -> dict[int, slice]:
    edges = np.r_[np.flatnonzero(_changes(bucket)), len(bucket)].tolist()
    return {int(bucket[a]): slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)}


def _sent(rows: DataFrame, sketch, window: int, anchor: int, buckets: int) -> DataFrame:
    """Windows of repeated anchors, packed: those that open a key in their slice by a bucket of the
    key, those settled inside the slice (runs of starts) by a bucket of their document."""
    names = ["bucket", "k1", "k2", "doc", "mark", "start", "gone_doc", "gone_mark", "gone_many", "gone_start"]

    def send(batch: pa.RecordBatch):
        found = _windows(batch, window, anchor, (0, 1))
        if not found:
            return
        row, start, place, grams, at, hashes = found
        places, back = np.unique(place, return_inverse=True)
        keep = sketch.value.holds(grams[places])[back]
        row, start, place, at = row[keep], start[keep], place[keep], at[keep]
        if not len(row):
            return
        k1, k2 = rolled(hashes[0], window)[at], rolled(hashes[1], window, 1)[at]
        doc = batch.column("doc").to_numpy()[row]
        mark = batch.column("mark").to_numpy()[row]
        start = start.astype("<i4")
        bucket = (k1 >> np.uint64(20)) % np.uint64(buckets)
        order = np.lexsort((start, doc, k2, k1))
        k1, k2, doc, mark, start, bucket = (x[order] for x in (k1, k2, doc, mark, start, bucket))
        later = _not_first(k1, k2, doc, start)
        gone = (doc[later], mark[later], start[later])
        home = mixed(gone[0].view(np.uint64) ^ mixed(gone[1].view(np.uint64), 1)) % np.uint64(buckets)
        order = np.lexsort((gone[2], gone[1], gone[0], home))
        home, *gone = (x[order] for x in (home, *gone))
        own = _changes(home, *gone)  # rows that repeat with one id and text: once
        home, *gone = (x[own] for x in (home, *gone))
        first = ~later
        order = np.lexsort((start[first], mark[first], doc[first], bucket[first]))
        bucket, k1, k2, doc, mark, start = (x[first][order] for x in (bucket, k1, k2, doc, mark, start))
        own = _changes(bucket, doc, mark, start)
        bucket, k1, k2, doc, mark, start = (x[own] for x in (bucket, k1, k2, doc, mark, start))
        opened, settled = _by_bucket(bucket), _by_bucket(home)
        none, out = slice(0, 0), []
        for n in sorted(opened.keys() | settled.keys()):
            o, g = opened.get(n, none), settled.get(n, none)
            gone_doc, gone_mark, gone_start = (x[g] for x in gone)
            run = np.flatnonzero(_changes(gone_doc, gone_mark))
            many = np.diff(np.r_[run, len(gone_doc)]).astype("<i4")
            out.append((n, *_packed(k1[o], k2[o], doc[o], mark[o], start[o], gone_doc[run], gone_mark[run], many, gone_start)))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "bucket" else pa.binary()) for n, c in zip(names, zip(*out, strict=True), strict=True)], names)

    return map_arrow(rows, send, ", ".join(f"{n} {'LONG' if n == 'bucket' else 'BINARY'}" for n in names))


def _settled(table: pa.Table) -> pa.Table:
    """``doc, mark, starts`` of one bucket: keys settled over all slices, and what slices have settled."""

    def column(name, kind):
        return np.frombuffer(b"".join(x for x in table.column(name).to_pylist()), kind)

    def blobs(start, ends):
        return [start[a:b].tobytes() for a, b in itertools.pairwise([0, *ends])]

    k1, k2, doc, mark, start = column("k1", np.uint64), column("k2", np.uint64), column("doc", np.int64), column("mark", np.int64), column("start", "<i4")
    order = np.lexsort((start, doc, k2, k1))
    k1, k2, doc, mark, start = (x[order] for x in (k1, k2, doc, mark, start))
    later = _not_first(k1, k2, doc, start)
    doc, mark, start = doc[later], mark[later], start[later]
    order = np.lexsort((start, mark, doc))
    doc, mark, start = doc[order], mark[order], start[order]
    edges = np.flatnonzero(_changes(doc, mark))
    ends = np.r_[edges[1:], len(doc)].tolist() if len(doc) else []
    starts = blobs(start, ends) + blobs(column("gone_start", "<i4"), np.cumsum(column("gone_many", "<i4"), dtype=np.int64).tolist())
    doc, mark = np.r_[doc[edges], column("gone_doc", np.int64)], np.r_[mark[edges], column("gone_mark", np.int64)]
    return pa.table({"doc": pa.array(doc, pa.int64()), "mark": pa.array(mark, pa.int64()), "starts": pa.array(starts, pa.binary())})


def sent_windows(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, log_width: int = LOG_WIDTH) -> DataFrame:
    """What goes to the exact grouping, one row a slice and bucket."""
    rows = _keyed(documents)
    spark = documents.sparkSession
    sketch = spark.sparkContext.broadcast(counted(rows.select("text"), lambda b: _anchors(b, window, anchor), 2, log_width))
    return _sent(rows, sketch, window, anchor, GROUPS * slots(spark))


def removed_windows(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, log_width: int = LOG_WIDTH) -> DataFrame:
    """``doc, mark, starts``: the windows (packed 32-bit starts) of each row that also start earlier."""
    return sent_windows(documents, window, anchor, log_width).groupBy("bucket").applyInArrow(_settled, "doc LONG, mark LONG, starts BINARY")


def _not_first(k1, k2, doc, start) -> np.ndarray:
    """Of rows sorted by key, id and start: those whose key starts earlier elsewhere."""
    n = len(k1)
    new = np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])] if n else np.empty(0, bool)
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if n else np.empty(0, np.int64)
    return (doc != doc[head]) | (start != start[head])


def flagged(documents: DataFrame, *keep, **how) -> DataFrame:
    """Each row with ``starts``, the list of its packed window starts (NULL without any), and the columns asked for."""
    gone = removed_windows(documents, **how).groupBy("doc", "mark").agg(F.collect_list("starts").alias("starts"))
    return _keyed(documents, *keep).join(gone, ["doc", "mark"], "left")


def _covered(n: int, starts: list[bytes] | None, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window to remove."""
    edge = np.zeros(n + 1, np.int64)
    for blob in starts or ():
        at = np.frombuffer(blob, "<i4")
        edge[at] += 1
        edge[at + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def kept_digests(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words, removed words, and a digest of the kept words joined by one space, per document (NULL text: none)."""

    def step(batch: pa.RecordBatch):
        out = ([], [], [])
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
            words = text.encode().split()
            if starts:
                gone = _covered(len(words), starts, window)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            else:
                kept = words
            for column, value in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = flagged(documents, F.col("doc_id").cast("long").alias("doc_id"), window=window).select("doc_id", "text", "starts")
    return map_arrow(rows, step, "doc_id LONG, n_words LONG, n_removed LONG, kept_sha256 STRING")


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without the repeated words; a text that loses some is its kept words joined by one space.

    All rows and columns stay (texts that lose everything become empty; NULL stays NULL); ``n_chars``
    counts what is left of a changed text.
    """
    names = documents.columns
    row = F.struct(*[F.col(f"`{n}`") for n in names]).alias("row")

    def step(batch: pa.RecordBatch):
        out, sizes = [], []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
            if not starts:
                out.append(None)
                sizes.append(None)
                continue
            words = text.encode().split()
            gone = _covered(len(words), starts, window)
            out.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode())
            sizes.append(len(out[-1]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string()), pa.array(sizes, pa.int64())], ["row", "changed", "size"])

    rows = flagged(documents, row, window=window).select("text", "starts", "row")
    schema = StructType([rows.schema["row"], StructField("changed", StringType()), StructField("size", LongType())])
    done = map_arrow(rows, step, schema)

    def column(name):
        old = F.col(f"row.`{name}`")
        if name == "text":
            return F.coalesce("changed", old).alias(name)
        return F.coalesce(F.col("size").cast(documents.schema[name].dataType), old).alias(name) if name == "n_chars" else old.alias(name)

    return done.select(*map(column, names))
