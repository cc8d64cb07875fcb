"""Token counts of the sections of a text, by offsets: the whole text is encoded once.

Each token's bytes give its span of characters (a token that holds part of a character spans
it).  Spans are joined with the sections' intervals; the rule for a token that touches several
sections is stated: ``"most"`` gives it to the one that holds most of its characters (the
earlier of equals), ``"first"`` to the one that holds its first character, or else the first it touches.
Sections may overlap and hold one another; by the same rules a token counts in one of them only, the one that starts
first (of these, ends first) where the rule leaves a choice.  A token that touches none, as a line end may, counts as ``outside``.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.llm.bpe import load_ranks
from trainlake.llm.common import map_arrow, texts
from trainlake.llm.packing import JSON_FILE, SPECIAL, SPECIAL_ID, encode

#: Number of the row that holds the tokens outside all sections.
OUTSIDE = -1


@functools.lru_cache(maxsize=2)
def _sizes(path: str) -> np.ndarray:
    ranks = load_ranks(path.removesuffix(".json") + ".tiktoken")
    out = np.zeros(max(max(ranks.values()), SPECIAL_ID) + 1, np.int64)
    for token, i in ranks.items():
        out[i] = len(token)
    out[SPECIAL_ID] = len(SPECIAL)
    return out


def token_spans(text: str, path: str = JSON_FILE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each token of a text, in characters."""
    ends = np.cumsum(_sizes(path)[np.frombuffer(encode(text, path), "<u4")])
    if not len(ends):
        return ends, ends
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[np.r_[0, ends[:-1]]], char[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, lows: np.ndarray, highs: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens by section, how many of them touch other sections too, and tokens outside.

    Sections are sorted by start and end; those without characters hold no token.
    """
    if rule not in ("most", "first"):
        raise ValueError(f"no rule {rule!r}")
    n, held = len(lows), np.flatnonzero(highs > lows)
    counts, crossing = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not len(held) or not len(starts):
        return counts, crossing, len(starts)
    # sections before the first end at or before the token's start, those after the last begin at or after its end
    first = np.searchsorted(np.maximum.accumulate(highs[held]), starts, "right")
    last = np.searchsorted(lows[held], ends, "left") - 1
    owner = first.copy()
    inside = last >= first
    crosses = []
    for t in np.flatnonzero(last > first).tolist():
        own = held[first[t] : last[t] + 1]
        shared = np.minimum(ends[t], highs[own]) - np.maximum(starts[t], lows[own])
        if rule == "most":
            choice = int(np.argmax(shared))
        else:
            begins = (shared > 0) & (lows[own] <= starts[t])
            choice = int(np.argmax(begins if begins.any() else shared > 0))
        owner[t] = first[t] + choice
        inside[t] = shared[choice] > 0
        if (shared > 0).sum() > 1:
            crosses.append(t)
    np.add.at(counts, held[owner[inside]], 1)
    np.add.at(crossing, held[owner[crosses]], 1)
    return counts, crossing, int((~inside).sum())


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The lines of a text without their line ends; the empty text has one empty line."""
    sizes = np.array([len(x) for x in text.split("\n")], np.int64)
    highs = np.cumsum(sizes + 1) - 1
    return highs - sizes, highs


def section_counts(documents: DataFrame, sections: DataFrame | None = None, path: str = JSON_FILE, rule: str = "most") -> DataFrame:
    """``doc_id, section, start, end, n_tokens, n_crossing`` per section, and a row ``OUTSIDE`` where tokens touch none.

    ``sections(doc_id, start, end)`` are joined by id, numbered by start and end; repeated ones are one, and those that
    end before they start, or lack an id or an end, are none.  Left out, sections are the lines of each text, found without a shuffle.  NULL text counts as empty, repeated rows are counted each.  Of a document
    without sections all tokens are outside.
    """
    rows = texts(documents)
    if sections is not None:
        given = sections.where("start <= end").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.sort_array(F.collect_set(F.struct(F.col("start").cast("long").alias("a"), F.col("end").cast("long").alias("b")))).alias("s"))
        rows = rows.join(given, F.col("doc_id") == F.col("id"), "left").select("text", "doc_id", F.col("s.a").alias("lows"), F.col("s.b").alias("highs"))
    given = sections is not None

    def step(batch: pa.RecordBatch):
        out: list[list] = [[] for _ in range(6)]
        spans = zip(batch.column("lows").to_pylist(), batch.column("highs").to_pylist(), strict=True) if given else None
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            lows, highs = (np.array(x or [], np.int64) for x in next(spans)) if spans else line_sections(text)
            counts, crossing, outside = attribute(*token_spans(text, path), lows, highs, rule)
            rows = [doc] * len(lows), range(len(lows)), lows.tolist(), highs.tolist(), counts.tolist(), crossing.tolist()
            for column, values in zip(out, rows, strict=True):
                column += values
            if outside:
                for column, value in zip(out, (doc, OUTSIDE, None, None, outside, 0), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return map_arrow(rows, step, "doc_id LONG, section INT, start LONG, end LONG, n_tokens LONG, n_crossing LONG")
