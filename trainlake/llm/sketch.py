"""Count-min sketches that are built in parts, merged by stripe, and small enough to broadcast.

Counters stop at two, as callers ask only "at least once?" or "at least twice?".  A sketch has
``ROWS`` rows of ``2 ** log_width`` counters; merged, one bit a counter is kept, so its size is
fixed by its parameters whatever it has counted: 16 MB by default, which the driver gathers and
broadcasts.  Estimates are never too low.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.llm.common import map_arrow, mixed, slots, small_batches

ROWS, LOG_WIDTH, LOG_STRIPE = 2, 26, 16


class Sketch:
    """The merged sketch: which counters have reached the count asked for."""

    def __init__(self, bits: np.ndarray, log_width: int):
        self.bits, self.log_width = bits, log_width

    def holds(self, values: np.ndarray) -> np.ndarray:
        """Mask of the values counted at least that often; some others too, none too few."""
        out = np.ones(len(values), bool)
        for row in range(ROWS):
            at = _counter(values, row, self.log_width)
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
        return out


def _counter(values: np.ndarray, row: int, log_width: int) -> np.ndarray:
    return (mixed(values, 101 + row) >> np.uint64(64 - log_width)) + np.uint64(row << log_width)


def _parts(values: np.ndarray, log_width: int, least: int) -> pa.RecordBatch:
    """Counters hit by ``values``, each up to ``least`` times, by stripe, as 16-bit numbers."""
    at = np.concatenate([_counter(values, row, log_width) for row in range(ROWS)])
    at.sort()
    again = np.zeros(len(at), np.int64)
    for k in range(1, least + 1):
        again[k:] += at[k:] == at[:-k]
    at = at[again < least]
    stripe = (at >> np.uint64(LOG_STRIPE)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1]]) if len(at) else np.empty(0, np.int64)
    within = (at & np.uint64((1 << LOG_STRIPE) - 1)).astype("<u2").tobytes()
    ends = np.r_[first[1:], len(at)] if len(at) else first
    return pa.RecordBatch.from_arrays(
        [pa.array(stripe[first], pa.int64()), pa.array([within[2 * a : 2 * b] for a, b in zip(first.tolist(), ends.tolist(), strict=True)], pa.binary())], ["stripe", "counters"]
    )


def counted(df: DataFrame, values_of: Callable[[pa.RecordBatch], np.ndarray], least: int = 2, log_width: int = LOG_WIDTH) -> Sketch:
    """Count ``values_of`` each slice of ``df``: partial sketches by slice, merged as a stream by stripe."""
    size, n_bits = 1 << LOG_STRIPE, ROWS << log_width

    def part(batch: pa.RecordBatch):
        values = values_of(batch)
        if len(values):
            yield _parts(values, log_width, least)

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for stripe, counters in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = held.get(stripe)
                if counts is None:
                    counts = held[stripe] = np.zeros(size, np.uint8)
                at = np.frombuffer(counters, "<u2")
                for k in range(least):  # sorted, each at most ``least`` times: its k-th mention
                    hit = at[k:][at[k:] == at[: len(at) - k]]
                    counts[hit] = np.minimum(counts[hit] + 1, least)
        for stripe, counts in held.items():
            reached = np.packbits(counts >= least, bitorder="little")
            yield pa.RecordBatch.from_arrays([pa.array([stripe], pa.int64()), pa.array([reached.tobytes()], pa.binary())], ["stripe", "reached"])

    stripes = map_arrow(df, part, "stripe LONG, counters BINARY").repartition(slots(df.sparkSession), "stripe").mapInArrow(merge, "stripe LONG, reached BINARY")
    bits = np.zeros(n_bits // 8, np.uint8)
    for batch in stripes.toArrow().to_batches():  # at most n_bits / 8 bytes in all
        for stripe, reached in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            bits[stripe * (size // 8) : (stripe + 1) * (size // 8)] = np.frombuffer(reached, np.uint8)
    return Sketch(bits, log_width)


#: Cells of the frequency table, and how many of them one part of it holds.
LOG_CELLS, LOG_CELL_PART = 23, 16


def frequency_classes(df: DataFrame, tokens_of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """A frequency class for each cell of hashed tokens (``class_of``): 0 for what chance explains.

    Each task counts all its tokens in one fixed table, the tables are summed by part.  Serves to order
    tokens only: a total order needs no exact counts.
    """
    cells, part = 1 << LOG_CELLS, 1 << LOG_CELL_PART

    def count(batches):
        from trainlake.llm.common import sliced

        held = np.zeros(cells, np.uint32)
        for batch in batches:
            for piece in sliced(batch):
                at = _cell(tokens_of(piece))
                at.sort()
                first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
                held[at[first]] += np.diff(np.r_[first, len(at)]).astype(np.uint32)
        for k in range(cells // part):
            own = held[k * part : (k + 1) * part]
            if own.any():
                # most cells hold little, so the counts of a part are sent in as few bytes as they need
                small = np.minimum(own, 255).astype(np.uint8)
                large = np.flatnonzero(own >= 255)
                rest = np.stack([large, own[large]]).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([_small(small)], pa.binary()), pa.array([rest.tobytes()], pa.binary())], ["part", "small", "rest"])

    def total(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, small, rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = _large(small, part).astype(np.int64)
                at, many = np.frombuffer(rest, "<u4").reshape(2, -1)
                n[at] = many
                held.setdefault(k, np.zeros(part, np.int64))[:] += n
        for k, n in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([_small(n.astype("<f4"))], pa.binary())], ["part", "n"])

    small_batches(df.sparkSession)
    parts = df.mapInArrow(count, "part LONG, small BINARY, rest BINARY").repartition(slots(df.sparkSession), "part").mapInArrow(total, "part LONG, n BINARY")
    sums = np.zeros(cells, np.float32)
    for batch in parts.toArrow().to_batches():  # at most 4 bytes a cell, and far fewer as they are packed
        for k, n in zip(*batch.columns, strict=True):
            sums[k.as_py() * part : (k.as_py() + 1) * part] = _large(n.as_py(), part, "<f4")
    usual = max(float(np.median(sums)), 1.0)
    classes = np.empty(cells, np.uint8)
    for at in range(0, cells, part):  # in pieces: the driver has little room
        over = (sums[at : at + part] - usual) / (5 * np.sqrt(usual) + 2)
        classes[at : at + part] = np.where(over > 1, 1 + np.log2(np.maximum(over, 1)), 0).astype(np.uint8)
    return classes


def _small(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), codec="zstd", asbytes=True)


def _large(packed: bytes, n: int, kind: str = "u1") -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (mixed(tokens, 77) >> np.uint64(64 - LOG_CELLS)).astype(np.int64)


def class_of(tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return classes[_cell(tokens)]


def members(df: DataFrame, column: str, log_width: int = LOG_WIDTH) -> Sketch:
    """A filter of the longs in a column: holds all of them, and few others."""
    return counted(df.select(F.col(column).cast("long").alias("value")), lambda b: b.column("value").drop_null().to_numpy(zero_copy_only=False).view(np.uint64), 1, log_width)
