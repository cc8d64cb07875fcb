"""Mixing sources to target weights by fitting subset sums to word budgets.

Sources are put in code point order, a missing one last, and weigh ``WEIGHTS`` in turn.
Together they take ``SHARE`` of all words; no source is asked for more than ``MOST`` times
its own, and what that leaves over goes to the others by weight, until none is above.

A source takes all its documents as often as its target allows; the rest of the target, less
than one pass, is a budget for a subset of the passes that are left.  Documents are counted by
exact length.  On these counts the budget is first spread over all lengths in proportion, then over the longest that
still fit, until it is below ``WINDOW`` words; a bounded-knapsack dynamic programme finds the
counts whose sum comes nearest to what is left.  Which documents of a length are taken is
settled by a seeded hash of id and text, so reruns agree whatever the partitioning.

NULL text has no words; documents without words are taken with nothing.  Rows without an id
take part like all others.  Repeated rows are documents of their own: which of two equal rows
is taken can't be told.  An empty table gives an empty mix.  Texts are read once; a source or a
length may hold any share of the rows: they are counted before each shuffle, and the rows of a
source and length are numbered in parts of about ``BUCKET``, as many as a table of ``2 ** LOG_CELLS``
counts (of hashed sources and lengths) asks for.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.llm.common import cut, slots

#: Weights of the sources, in turn; share of all words that is taken; most passes over a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Most words that are left to the dynamic programme.
WINDOW = 1 << 16
#: Rows that a part of one length holds at most, about.
BUCKET, LOG_CELLS = 1024, 16
SEED = 20240501
_SOURCE = ("no_source", "of")


def nearest_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How often to take each length (at most its count) so that the sum comes nearest to the budget, not above
    twice the budget; of equally near sums the smaller.  Work and memory are bounded by the budget.

    ``first[s]`` is the item by which the sum ``s`` was first reached; its last copy leads back to ``s - length``.
    """
    taken = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return taken
    top = 2 * budget
    first = np.full(top + 1, -1, np.int32)
    first[0] = len(lengths)
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        if first[budget] >= 0:
            break
        front = np.flatnonzero(first >= 0)
        for _ in range(min(count, top // length)):
            front = front[front <= top - length] + length
            front = front[first[front] < 0]
            if not len(front):
                break
            first[front] = i
    sums = np.flatnonzero(first >= 0)
    at = int(sums[np.lexsort((sums, np.abs(sums - budget)))[0]])
    while at:
        taken[first[at]] += 1
        at -= int(lengths[first[at]])
    return taken


def fitted_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to take for a budget below the sum of all."""
    order = np.argsort(-lengths, kind="stable")
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    total = int((lengths * counts).sum())
    taken = np.zeros(len(lengths), np.int64)
    left = min(max(budget, 0), total)
    if left > window:
        # in proportion, rounded so that what is taken so far stays just below its share
        taken = np.array([left * c // total for c in counts.tolist()], np.int64)
        left -= int((lengths * taken).sum())
        for i in range(len(lengths)):
            if left <= window:
                break
            more = min(int(counts[i] - taken[i]), left // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    taken += nearest_sum(lengths, counts - taken, min(left, window))
    out = np.empty(len(taken), np.int64)
    out[order] = taken
    return out


def word_sizes(documents: DataFrame, seed: int = SEED, keep: tuple[Column, ...] = ()) -> DataFrame:
    """``doc_id, source, no_source, of, size, draw``: the words of each text, and its seeded hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"),
        source.isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("of"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text).alias("draw"), *keep,
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``no_source, of, source_size, target`` of every source in ``sizes(no_source, of, size)``.

    Sources are numbered in parts of a range partitioning, so no task sees them all; the driver sees the
    size of each part, and a few sums for every round of resharing.
    """
    spark = sizes.sparkSession
    sums = sizes.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    parts = cut(sums.repartitionByRange(slots(spark), *_SOURCE).withColumn("part", F.spark_partition_id()))
    before, offsets = 0, []
    for r in parts.groupBy("part").count().orderBy("part").collect():
        offsets.append((r["part"], before))
        before += r["count"]
    ahead = spark.createDataFrame(offsets, "part INT, ahead LONG")  # one row a part
    place = F.col("ahead") + F.row_number().over(Window.partitionBy("part").orderBy(*_SOURCE)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int") + 1)
    weighed = cut(parts.join(F.broadcast(ahead), "part").select(*_SOURCE, "source_size", weight.alias("weight")))

    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    capped, before = F.lit(False), None
    while True:
        sums = weighed.agg(F.sum(F.when(capped, most * F.col("source_size"))), F.sum(F.when(~capped, F.col("weight")))).first()
        level = (share * total - (sums[0] or 0)) / sums[1] if sums[1] else 0.0
        if sums == before or not sums[1]:
            break
        # the level only rises, so a source that is above it once stays above
        capped, before = F.col("weight") * level > most * F.col("source_size"), sums
    target = F.when(capped, (most * F.col("source_size")).cast("double")).otherwise(F.col("weight") * level)
    return weighed.select(*_SOURCE, "source_size", target.alias("target"))


def mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
    seed: int = SEED, window: int = WINDOW, bucket: int = BUCKET, keep: tuple[Column, ...] = (),
) -> DataFrame:
    """``doc_id, source, size, source_size, target, times, taken`` for every document, with the columns to keep.

    A document is taken whole, ``times`` times: ``taken`` is its size times that.
    """
    sized = cut(word_sizes(documents, seed, keep))
    cell = F.pmod(F.xxhash64(*_SOURCE, "size"), F.lit(1 << LOG_CELLS)).alias("cell")
    crowds = cut(sized.groupBy(cell).agg(F.ceil(F.count("*") / bucket).alias("parts")))  # one row a cell at most
    rows = sized.select(cell, "*").join(F.broadcast(crowds), "cell").withColumn("part", F.pmod(F.xxhash64("draw"), F.col("parts"))).drop("cell", "parts")
    counted = cut(rows.groupBy(*_SOURCE, "size", "part").agg(F.count("*").alias("n")))
    targets = cut(source_targets(counted.select(*_SOURCE, (F.col("size") * F.col("n")).alias("size")), weights, share, most))
    passes = F.least(F.lit(most), F.floor(F.try_divide(F.col("target"), F.col("source_size")))).cast("long")
    targets = targets.select(*_SOURCE, "source_size", "target", F.coalesce(passes, F.lit(0).cast("long")).alias("passes"))
    budget = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    lengths = counted.where("size > 0").groupBy(*_SOURCE, "size").agg(F.sum("n").alias("n"))
    copies = F.col("n") * (most - F.col("passes"))
    histogram = lengths.join(targets, [*_SOURCE]).select(*_SOURCE, "size", "n", copies.alias("copies"), budget.alias("budget"))

    def fit(lengths: pa.Table) -> pa.Table:
        size, n, copies = (lengths.column(c).to_numpy() for c in ("size", "n", "copies"))
        more = fitted_counts(size, copies, lengths.column("budget")[0].as_py(), window)
        return pa.table({**{c: lengths.column(c) for c in (*_SOURCE, "size")}, "all": pa.array(more // n), "some": pa.array(more % n)})

    # a group is the histogram of one source: a row for each different length
    extra = histogram.groupBy(*_SOURCE).applyInArrow(fit, "no_source BOOLEAN, of STRING, size LONG, all LONG, some LONG")
    ahead = F.sum("n").over(Window.partitionBy(*_SOURCE, "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    chosen = F.least(F.col("n"), F.greatest(F.lit(0), F.coalesce("some", F.lit(0)) - F.coalesce(ahead, F.lit(0))))
    shares = counted.join(extra, [*_SOURCE, "size"], "left").select(*_SOURCE, "size", "part", F.coalesce("all", F.lit(0)).alias("all"), chosen.alias("chosen"))
    shares = cut(shares.join(targets, [*_SOURCE]))
    placed = rows.join(shares, [*_SOURCE, "size", "part"])
    rank = F.row_number().over(Window.partitionBy(*_SOURCE, "size", "part").orderBy("draw", "doc_id"))
    taken = placed.withColumn("times", F.col("passes") + F.col("all") + (rank <= F.col("chosen")).cast("long"))
    own = ("doc_id", "source", "size", "source_size", "target", "times")
    kept = [c for c in sized.columns if c not in {"doc_id", "source", "size", "draw", *_SOURCE}]
    return taken.select(*own, (F.col("size") * F.col("times")).alias("taken"), *kept)


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns."""
    row = F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("row")
    found = mix(documents, keep=(row,), **options).where("times > 0 AND size > 0")
    return found.select(F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")).select("row.*")
