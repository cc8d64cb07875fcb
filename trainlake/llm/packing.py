"""Best-fit packing of whole documents into fixed-size sequences, by large-item matching.

A piece above a third of the capacity shares its sequence with at most one other such
piece: the largest is matched with the largest partner that still fits.  Smaller pieces
then go, largest first, to the tightest gap that takes them.  Lengths are whole numbers up
to the capacity, so the plan is made on the histogram of lengths, in batches of equal
sequences: its size depends on the capacity, never on the number of pieces.  Each piece
finds its place by its rank among those of its length.
"""

import functools
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainlake.llm.bpe import MAX_WORDS, load_ranks, pre_tokens
from trainlake.llm.common import cut, map_arrow, texts

CAPACITY = 1024
#: Parts into which the pieces of one length are dealt while they are numbered.
SALTS = 128
END_ID = 2
JSON_FILE = public_tokenizers.path("byte_bpe_50k.json")


class _Ids(dict):
    """Pre-token → packed ids; holds at most ``MAX_WORDS``."""

    def __init__(self, path: str):
        super().__init__()
        ranks = load_ranks(path.removesuffix(".json") + ".tiktoken")
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MAX_WORDS:
            self.clear()
        made = self[word] = np.array(self.encode(word), "<u4").tobytes()
        return made


@functools.lru_cache(maxsize=2)
def _ids(path: str) -> _Ids:
    return _Ids(path)


#: Fixed value: the one special token of the vocabulary file, which its library also finds inside texts.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


def encode(text: str, path: str = JSON_FILE) -> bytes:
    """Ids as the ``tokenizers`` library gives them for the file, packed; by the same ranks, some times faster."""
    of = _ids(path).__getitem__
    if SPECIAL not in text:
        return b"".join(map(of, pre_tokens(text)))
    mark = np.array([SPECIAL_ID], "<u4").tobytes()
    return mark.join(b"".join(map(of, pre_tokens(part))) for part in text.split(SPECIAL))


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all but the first are full."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(documents: DataFrame, capacity: int = CAPACITY, path: str = JSON_FILE, end_id: int = END_ID) -> DataFrame:
    """Pieces of every whole document's ids, each document closed by ``end_id``; empty text has that id alone."""
    end = np.array([end_id], "<u4").tobytes()

    def step(batch: pa.RecordBatch):
        out = ([], [], [], [], [])
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = encode(text, path) + end
            for k, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                for column, value in zip(out, (doc, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(texts(documents), step, "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places for ``counts`` pieces by length: rows of (length, first rank, first sequence, pieces a sequence, offset)."""
    left = {n: c for n, c in counts.items() if c > 0}
    ranks: dict[int, int] = defaultdict(int)
    rows, sequences = [], 0
    gaps: list[int] = []  # sorted
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap → (first sequence, how many)

    def place(length, first, many, each, offset):
        rows.append((length, ranks[length], first, each, offset))
        ranks[length] += many * each
        left[length] -= many * each

    def open_group(gap, first, many):
        if gap and many:
            if not groups[gap]:
                insort(gaps, gap)
            groups[gap].append((first, many))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        i = bisect_left(large, min(a, capacity - a) + 1) - 1
        while i >= 0 and (not left[large[i]] or (large[i] == a and left[a] < 2)):
            i -= 1
        if i < 0:
            many = left[a]
            place(a, sequences, many, 1, 0)
            open_group(capacity - a, sequences, many)
        else:
            b = large[i]
            many = left[a] // 2 if a == b else min(left[a], left[b])
            if a == b:
                place(a, sequences, many, 2, 0)
            else:
                place(a, sequences, many, 1, 0)
                place(b, sequences, many, 1, a)
            open_group(capacity - a - b, sequences, many)
        sequences += many

    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            i = bisect_left(gaps, s)
            if i == len(gaps):
                many = -(-left[s] // (capacity // s))
                open_group(capacity, sequences, many)
                sequences += many
                i = bisect_left(gaps, s)
            gap = gaps[i]
            first, many = groups[gap].pop()
            if not groups[gap]:
                gaps.pop(i)
            each = min(gap // s, left[s])  # the tightest gap stays the tightest until it is full
            used = min(many, left[s] // each)
            place(s, first, used, each, capacity - gap)
            open_group(gap - each * s, first, used)
            open_group(gap, first + used, many - used)
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """``pieces`` (as of ``token_pieces``, lengths 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Two reads of a written table; the driver holds at most ``capacity * salts`` counts.  Pieces of one
    length are numbered in ``salts`` parts, so a length with a third of all rows is spread.  Repeated
    rows are packed each; an empty table gives an empty one.
    """
    salted = cut(pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")))
    counted = salted.groupBy("length", "salt").count().toArrow().to_pydict()
    cells = np.zeros((capacity + 1, salts), np.int64)
    cells[np.array(counted["length"], np.int64), np.array(counted["salt"], np.int64)] = counted["count"]
    before = np.cumsum(cells, axis=1) - cells
    rows = sorted(plan({n: int(c) for n, c in enumerate(cells.sum(axis=1)) if c}, capacity))
    lengths, first_rank, first_sequence, each, at = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(1, np.int64),) * 5
    keys = lengths << 42 | first_rank

    def step(batch: pa.RecordBatch):
        n, salt, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "salt", "rank"))
        rank = rank - 1 + before[n, salt]
        row = np.searchsorted(keys, n << 42 | rank, "right") - 1
        past = rank - first_rank[row]
        sequence, offset = first_sequence[row] + past // each[row], at[row] + past % each[row] * n
        kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order).cast("long"))
    return map_arrow(ranked, step, "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG, sequence_id LONG, offset LONG")


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, path: str = JSON_FILE) -> DataFrame:
    return pack(token_pieces(documents, capacity, path), capacity)
