"""What the operators share: reading tables, cutting lineage, Arrow batches, word hashes."""

import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text characters per slice of an Arrow batch; bounds the memory of vectorised steps.
SLICE_BYTES = 4 << 20
#: Data from which on Spark closes an Arrow batch, a little less than a slice; by itself it goes by 10,000 rows,
#: of which it keeps several copies outside its heap, and the Python worker another.
BATCH_BYTES = SLICE_BYTES - SLICE_BYTES // 16
#: Text whose words are hashed at a time: the arrays for that take forty times as much.
PIECE_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """The path of a new table in the shared folder."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back: computed once, lineage ends."""
    path = path or scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame, path: str) -> None:
    """Empty a table that ``cut`` has written, once nothing is left that could read it again.

    Not by rows from the driver, which start further Python workers.
    """
    none = df.sparkSession.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    none.write.mode("overwrite").parquet(path)


def slots(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session states them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Have the session send Arrow batches of ``BATCH_BYTES`` (or one row), unless it states a size of its own.

    Spark looks the size up when it runs a plan, so it stays set.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def map_arrow(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``step`` over slices of Arrow batches of at most ``SLICE_BYTES`` of data (or one row)."""

    def run(batches):
        for batch in batches:
            for piece in sliced(batch):
                yield from step(piece)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def sliced(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch by the bytes of its binary and text columns, those inside structs too."""
    sizes = np.zeros(batch.num_rows, np.int64)
    columns = list(batch.columns)
    while columns:
        column = columns.pop()
        if pa.types.is_struct(column.type):
            columns += column.flatten()
        elif batch.num_rows and (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
            sizes += np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4))
    if batch.num_rows < 2 or int(sizes.sum()) <= most:
        yield batch
        return
    step = np.cumsum(sizes, dtype=np.int64) // most
    cuts = np.flatnonzero(np.diff(step)) + 1
    for a, b in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without NULLs, and where each row starts (one more at the end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


#: Fixed odd multipliers of the two rolling hashes, and of the final mixing.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers with good high and low bits."""
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(MIX[1])
    x ^= x >> np.uint64(32)
    x = x * np.uint64(BASES[1])
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * np.uint64(pow(base, done, 1 << 64))
        done += take
    return out[:n]


def word_bounds(raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word (a run of bytes not among ``gaps``), and the first word of each row (one more at the end)."""
    gap = gaps[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    inside = ~gap
    first = inside.copy()
    first[1:] &= gap[:-1] | edge[1:-1]
    last = inside
    last[:-1] &= gap[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over the bytes, mixed with the length.

    It doesn't depend on where a word stands, so the words (in order) are hashed by pieces of the text.
    """
    out, done = np.empty(len(starts), np.uint64), 0
    while done < len(starts):
        at = int(starts[done])
        # the words that start within the piece, the last of them whole
        upto = int(np.searchsorted(starts, at + PIECE_BYTES))
        here = slice(done, upto)
        out[here] = _hashed(raw[at : int(ends[upto - 1])], starts[here] - at, ends[here] - at, which, lower)
        done = upto
    return out


def _hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int, lower: bool) -> np.ndarray:
    base = BASES[which]
    values = (_LOWER[raw] if lower else raw).astype(np.uint64)
    values += np.uint64(1)
    values *= powers(base, len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    back = powers(pow(base, -1, 1 << 64), len(raw) + 1)
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64), which + 1)


def rolled(hashes: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each ``n`` consecutive hashes (also across rows: callers mask those)."""
    base = BASES[which]
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    values = hashes * powers(base, len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    back = powers(pow(base, -1, 1 << 64), len(hashes))
    return mixed((sums[n:] - sums[:-n]) * back[: len(hashes) - n + 1], which + 11)


def texts(documents: DataFrame, *keep: Column) -> DataFrame:
    """``doc_id`` as long and ``text`` with NULL as empty; nothing else unless asked for."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *keep)
