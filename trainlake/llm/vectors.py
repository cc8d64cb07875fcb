"""Nearest neighbours by a searched k-means tree, and exact top-k inner products by uniform thresholds.

Both take ``vec_id`` and ``embedding``.  Rows without an id, and vectors that are NULL or hold NULL or
non-finite components, take no part; of repeated ids the least vector counts; of vectors of different
lengths those of the commonest length count (the longer of equals).
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.llm.common import cut, map_arrow

#: Most vectors the tree is fitted on and most queries it is calibrated with (both drawn by hashes of ids).
MAX_SAMPLE, MAX_CALIBRATION = 20_000, 64
BRANCHES, LEAF_SAMPLE = 8, 160
TARGET_RECALL = 0.97
#: Most rows and most queries of one task's block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024


def usable(embeddings: DataFrame, zero: bool = True) -> DataFrame:
    """``vec_id, x``: the packed doubles of each vector that takes part (``zero``: zero vectors too)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    fine = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(math.inf)))
    if not zero:
        fine &= F.exists("x", lambda v: v != 0)
    rows = cut(rows.where(fine & (F.size("x") > 0)).groupBy("vec_id").agg(F.min("x").alias("x")))
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("x") == (usual["d"] if usual else 0))

    def pack(batch: pa.RecordBatch):
        x = batch.column("x")
        flat = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.empty((0, 1))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in flat], pa.binary())], ["vec_id", "x"])

    return map_arrow(rows, pack, "vec_id LONG, x BINARY")


def _matrix(column) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1) if blobs else np.empty((0, 1))


# --- hierarchical k-means tree ----------------------------------------------------------------


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1)[None, :] - 2 * x @ centres.T, axis=1)


class Tree:
    """Nodes by number; ``children[n]`` is empty for leaves; leaves are counted from 0."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf_sample: int = LEAF_SAMPLE, seed: int = 7):
        self.children: list[list[int]] = []
        self.centres: list[np.ndarray] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._grow(sample, sample.mean(axis=0) if len(sample) else np.zeros(1), branches, leaf_sample, np.random.default_rng(seed))

    def _grow(self, x, centre, branches, leaf_sample, rng) -> int:
        node = len(self.centres)
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        if len(x) > leaf_sample:
            centres = _k_means(x, min(branches, len(x)), rng)
            near = _nearest(x, centres)
            groups = [k for k in range(len(centres)) if (near == k).any()]
            if len(groups) > 1:
                self.children[node] = [self._grow(x[near == k], centres[k], branches, leaf_sample, rng) for k in groups]
                return node
        self.leaf[node] = self.leaves
        self.leaves += 1
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the nearest child."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            near = _nearest(x[rows], np.stack([self.centres[c] for c in below]))
            todo += [(c, rows[near == k]) for k, c in enumerate(below) if (near == k).any()]
        return out

    def best_first(self, q: np.ndarray):
        """The leaves in the order in which a priority queue of centre distances reaches them."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield self.leaf[node]
                continue
            apart = np.stack([self.centres[c] for c in below]) - q
            for d, c in zip((apart * apart).sum(1).tolist(), below, strict=True):
                heapq.heappush(queue, (d, c))


def _least(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` smallest scores are, in order, ties to smaller ids."""
    if len(scores) > 4 * k:
        most = np.partition(scores, k - 1)[k - 1]
        near = np.flatnonzero(scores <= most)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], scores[near]))[:k]]


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = x - q
    return np.sqrt((apart * apart).sum(axis=1))


def _draw(rows: DataFrame, n: int, most: int, seed: int) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, most / max(n, 1))) + (n <= most))


class TreeIndex:
    """An index over all rows; ``visits`` leaves are looked at per query, as calibration found enough,
    and more where these hold fewer than ``k`` rows besides the query."""

    def __init__(self, rows: DataFrame, queries: Column, k: int = 10, target: float = TARGET_RECALL):
        self.spark, self.k = rows.sparkSession, k
        n = rows.count()
        self.tree = Tree(_matrix(_draw(rows, n, MAX_SAMPLE, 1).select("x").toArrow().column("x")))
        self.shared = shared = self.spark.sparkContext.broadcast(self.tree)

        def place(batch: pa.RecordBatch):
            leaf = shared.value.assign(_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], ["vec_id", "x", "leaf"])

        self.rows = cut(map_arrow(rows.select("vec_id", "x"), place, "vec_id LONG, x BINARY, leaf LONG"))
        self.queries = self.rows.where(queries)
        asked = self.queries.count()
        probes = _draw(self.queries, asked, MAX_CALIBRATION, 2).limit(2 * MAX_CALIBRATION).select("vec_id", "x").toArrow()
        self.visits = self._calibrated(probes, target)

    def _calibrated(self, probes: pa.Table, target: float) -> int:
        """The least number of leaves that hold the target share of the true neighbours of the probes."""
        ids, xs, k = probes.column("vec_id").to_numpy(), _matrix(probes.column("x")), self.k
        if not len(ids) or self.tree.leaves == 1:
            return 1
        given = self.spark.sparkContext.broadcast((ids, xs))

        def nearest(batch: pa.RecordBatch):
            own, x, leaf = batch.column("vec_id").to_numpy(), _matrix(batch.column("x")), batch.column("leaf").to_numpy()
            out = []
            for j, q in zip(given.value[0].tolist(), given.value[1], strict=True):
                d = _distances(x, q)
                d[own == j] = np.inf
                out += [(j, int(own[i]), float(d[i]), int(leaf[i])) for i in _least(own, d, k).tolist() if d[i] < np.inf]
            yield pa.RecordBatch.from_pylist([dict(zip(("q", "vec_id", "d", "leaf"), o, strict=True)) for o in out], pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("d", pa.float64()), ("leaf", pa.int64())]))

        found = map_arrow(self.rows, nearest, "q LONG, vec_id LONG, d DOUBLE, leaf LONG")
        true = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("d", "vec_id"))).where(F.col("rank") <= k).select("q", "leaf").toArrow()
        at = {}
        for j, q in zip(ids.tolist(), xs, strict=True):
            at[j] = {leaf: n for n, leaf in enumerate(self.tree.best_first(q), 1)}
        needed = np.sort([at[q][leaf] for q, leaf in zip(true.column("q").to_pylist(), true.column("leaf").to_pylist(), strict=True)])
        return int(needed[max(0, math.ceil(target * len(needed)) - 1)]) if len(needed) else 1

    def search(self) -> DataFrame:
        """``query_id, rank, vec_id, score`` of the nearest found, in blocks of leaf rows and leaf queries."""
        k, visits, shared = self.k, self.visits, self.shared
        many = {r["leaf"]: r["count"] for r in self.rows.groupBy("leaf").count().collect()}  # one row a leaf, as below

        def visit(batch: pa.RecordBatch):
            leaves = []
            for q in _matrix(batch.column("x")):
                own, held = [], 0
                for leaf in shared.value.best_first(q):
                    if len(own) >= visits and held > k:
                        break
                    own.append(leaf)
                    held += many.get(leaf, 0)
                leaves.append(own)
            row = pa.array(np.repeat(np.arange(len(leaves)), [len(x) for x in leaves]))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(row), batch.column("x").take(row), pa.array([n for x in leaves for n in x], pa.int64())], ["query_id", "q", "leaf"])

        asked = map_arrow(self.queries.select("vec_id", "x"), visit, "query_id LONG, q BINARY, leaf LONG")
        asks = {r["leaf"]: r["count"] for r in asked.groupBy("leaf").count().collect()}
        blocks = self.spark.createDataFrame([(n, -(-c // BLOCK_ROWS), -(-asks.get(n, 1) // BLOCK_QUERIES)) for n, c in many.items()] or [(0, 1, 1)], "leaf LONG, parts LONG, turns LONG")
        blocks = F.broadcast(blocks)
        rows = self.rows.join(blocks, "leaf").select("leaf", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn"), "vec_id", "x")
        asked = asked.join(blocks, "leaf").select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("query_id"), F.col("turns")).alias("turn"), "query_id", "q")
        key = ("leaf", "part", "turn")

        def compare(own: pa.Table, other: pa.Table) -> pa.Table:
            ids, x = own.column("vec_id").to_numpy(), _matrix(own.column("x"))
            out = ([], [], [])
            for j, q in zip(other.column("query_id").to_pylist(), _matrix(other.column("q")), strict=True):
                d = _distances(x, q) if len(x) else np.empty(0)
                near = [i for i in _least(ids, d, k + 1).tolist() if ids[i] != j][:k]
                for column, value in zip(out, (j, ids[near].tolist(), d[near].tolist()), strict=True):
                    column.append(value)
            return pa.table({"query_id": pa.array(out[0], pa.int64()), "ids": pa.array(out[1], pa.list_(pa.int64())), "scores": pa.array(out[2], pa.list_(pa.float64()))})

        found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(compare, "query_id LONG, ids ARRAY<LONG>, scores ARRAY<DOUBLE>")
        found = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("f")).select("query_id", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(embeddings: DataFrame, queries: Column, k: int = 10, target: float = TARGET_RECALL) -> DataFrame:
    """The ``k`` nearest rows found for each row that is a query (a condition on ``vec_id``), by Euclidean distance."""
    return TreeIndex(usable(embeddings, zero=False), queries, k, target).search()


# --- exact top-k by three-phase uniform thresholds ---------------------------------------------

#: Local score lists into which an inner product is split (by components), and entries that each gives at first.
LISTS, HEADS = 2, 16
SCALE = 256


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products, rows by queries."""
    bound = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    return (x @ q.T).astype(np.int64) if bound < 2**53 else x.astype(np.int64) @ q.astype(np.int64).T


def _parts(d: int, lists: int) -> list[slice]:
    edges = [d * i // lists for i in range(lists + 1)]
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class UniformThreshold:
    """Exact top-k sums of ``lists`` local scores, by three phases.

    A list is a block of components; its slices of the vectors are in groups of their own, and no group sees
    the scores of another list.

    1. Every list gives the heads of its local scores for each query.  The scores that the
       heads lack are fetched from the other lists, for the heads alone.  The k-th best of these sums
       is a safe floor for the k-th best of all.
    2. A row that reaches the floor has a share of it, the floor divided by the number of lists, in
       one list at least.  With that uniform cutoff every list collects the entries at or above it.
       A score not sent is below the cutoff, which bounds a row's sum; rows bound below the floor fall out.
    3. What remains lacks some scores: these lists, and no others, are asked for them.

    Equal vectors are one row with its ``k + 1`` smallest ids.
    """

    def __init__(self, rows: DataFrame, queries: Column, k: int, lists: int = LISTS, scale: int = SCALE):
        self.k, self.lists = k, lists

        def whole(batch: pa.RecordBatch):
            x = np.floor(scale * _matrix(batch.column("x"))) + 0.0
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "x"])

        points = cut(map_arrow(rows, whole, "vec_id LONG, x BINARY"))
        ranked = points.withColumn("n", F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))).where(F.col("n") <= k + 1)
        same = cut(ranked.groupBy("x").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
        asked = points.where(queries).select(F.col("vec_id").alias("id"), "x")
        self.ids = same.select("id", "ids", F.size("ids").cast("long").alias("many"))
        self.slices = cut(self._sliced(same.select("id", "x")))
        self.asks = cut(self._sliced(asked)).select("list", F.col("id").alias("query_id"), F.col("s").alias("q"))
        n, m = same.count(), asked.count()
        self.parts, self.turns = max(1, -(-n // BLOCK_ROWS)), max(1, -(-m // BLOCK_QUERIES))

    def _sliced(self, rows: DataFrame) -> DataFrame:
        """``list, id, s``: the components of each list, filled up with zeros to one length."""
        lists = self.lists

        def step(batch: pa.RecordBatch):
            x = _matrix(batch.column("x"))
            width = -(-x.shape[1] // lists)
            for i, part in enumerate(_parts(x.shape[1], lists)):
                own = np.zeros((len(x), width))
                own[:, : part.stop - part.start] = x[:, part]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), i)), batch.column("id"), pa.array([r.tobytes() for r in own], pa.binary())], ["list", "id", "s"])

        return map_arrow(rows, step, "list LONG, id LONG, s BINARY")

    def _blocks(self, asks: DataFrame, step, schema: str) -> DataFrame:
        """``step(slices, queries)`` for every block of rows with every block of queries of the same list."""
        part, turn = F.pmod(F.xxhash64("id"), F.lit(self.parts)), F.pmod(F.xxhash64("query_id"), F.lit(self.turns))
        rows = self.slices.select("list", part.alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.turns - 1).cast("long"))).alias("turn"), "id", "s")
        asks = asks.select("list", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.parts - 1).cast("long"))).alias("part"), turn.alias("turn"), *(c for c in asks.columns if c != "list"))
        key = ("list", "part", "turn")
        return rows.groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(step, schema)

    def _fetched(self, lacking: DataFrame) -> DataFrame:
        """``query_id, id, score`` of single entries ``list, query_id, id``."""
        met = lacking.join(self.slices, ["list", "id"]).join(self.asks, ["list", "query_id"]).select("query_id", "id", "s", "q")

        def step(batch: pa.RecordBatch):
            x, q = _matrix(batch.column("s")), _matrix(batch.column("q"))
            bound = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
            score = (x * q).sum(axis=1).astype(np.int64) if bound < 2**53 else (x.astype(np.int64) * q.astype(np.int64)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(score, pa.int64())], ["query_id", "id", "score"])

        return map_arrow(met, step, "query_id LONG, id LONG, score LONG")

    def _completed(self, sums: DataFrame) -> DataFrame:
        """``query_id, id, score`` from ``query_id, id, score, sent`` (the lists that are in the score), the others fetched."""
        lists = F.array(*(F.lit(i).cast("long") for i in range(self.lists)))
        lacking = sums.select("query_id", "id", F.explode(F.array_except(lists, "sent")).alias("list"))
        return sums.select("query_id", "id", "score").unionByName(self._fetched(lacking)).groupBy("query_id", "id").agg(F.sum("score").alias("score"))

    def _floors(self) -> DataFrame:
        """Phase 1: ``query_id, floor``."""
        heads = max(HEADS, self.k + 1)

        def local(own: pa.Table, asks: pa.Table) -> pa.Table:
            columns: list[list] = [[], [], []]
            if own.num_rows and asks.num_rows:
                ids, scores = own.column("id").to_numpy(), _products(_matrix(own.column("s")), _matrix(asks.column("q")))
                for j, query in enumerate(asks.column("query_id").to_pylist()):
                    first = _least(ids, -scores[:, j], heads)
                    for column, value in zip(columns, (np.full(len(first), query), ids[first], scores[first, j]), strict=True):
                        column.append(value)
            flat = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in columns]
            of = pa.array(np.full(len(flat[0]), own.column("list")[0].as_py() if own.num_rows else 0))
            return pa.table(dict(zip(("list", "query_id", "id", "score"), (of, *flat), strict=True)))

        found = self._blocks(self.asks, local, "list LONG, query_id LONG, id LONG, score LONG")
        rank = F.row_number().over(Window.partitionBy("list", "query_id").orderBy(F.desc("score"), "id"))
        first = cut(found.withColumn("n", rank).where(F.col("n") <= heads).drop("n"))
        sums = first.groupBy("query_id", "id").agg(F.sum("score").alias("score"), F.collect_list("list").alias("sent"))
        whole = self._completed(sums).join(self.ids, "id")
        # the query's own id may be one of its vector's: so one of them doesn't count
        at = Window.partitionBy("query_id").orderBy(F.desc("score"), "id").rowsBetween(Window.unboundedPreceding, 0)
        reached = whole.withColumn("reached", F.sum("many").over(at)).where(F.col("reached") >= self.k + 1)
        return cut(reached.groupBy("query_id").agg(F.max("score").alias("floor")))

    def best(self) -> DataFrame:
        """``query_id, rank, vec_id, score``: the ``k`` best rows but the query's own, ties to smaller ids."""
        k, lists = self.k, self.lists
        floors = self._floors()
        cutoff = F.ceil(F.col("floor") / lists).cast("long")
        asks = self.asks.join(floors.select("query_id", cutoff.alias("cutoff")), "query_id", "left")

        def collect(own: pa.Table, asks: pa.Table) -> pa.Table:
            columns: list[list] = [[], [], []]
            if own.num_rows and asks.num_rows:
                ids, scores = own.column("id").to_numpy(), _products(_matrix(own.column("s")), _matrix(asks.column("q")))
                for j, (query, cutoff) in enumerate(zip(asks.column("query_id").to_pylist(), asks.column("cutoff").to_pylist(), strict=True)):
                    rows = np.arange(len(ids)) if cutoff is None else np.flatnonzero(scores[:, j] >= cutoff)
                    for column, value in zip(columns, (np.full(len(rows), query), ids[rows], scores[rows, j]), strict=True):
                        column.append(value)
            flat = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in columns]
            of = pa.array(np.full(len(flat[0]), own.column("list")[0].as_py() if own.num_rows else 0))
            return pa.table(dict(zip(("list", "query_id", "id", "score"), (of, *flat), strict=True)))

        entries = self._blocks(asks, collect, "list LONG, query_id LONG, id LONG, score LONG")
        sums = entries.groupBy("query_id", "id").agg(F.sum("score").alias("score"), F.collect_list("list").alias("sent"))
        bound = F.col("score") + (lists - F.size("sent")) * (cutoff - 1)
        open_ = sums.join(floors, "query_id", "left").where(F.col("floor").isNull() | (bound >= F.col("floor")))
        each = self._completed(cut(open_.select("query_id", "id", "score", "sent")))
        each = each.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("n") <= k + 1)
        each = each.join(self.ids, "id").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best_products(embeddings: DataFrame, queries: Column, k: int = 5, lists: int = LISTS, scale: int = SCALE) -> DataFrame:
    """Exact top ``k`` integer inner products of ``floor(scale * x)`` for each row that is a query."""
    return UniformThreshold(usable(embeddings), queries, k, lists, scale).best()
