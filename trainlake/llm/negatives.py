"""Hard negatives from Hilbert-ordered Parquet blocks with zone maps.

Vectors become whole numbers.  The rows are ordered along a Hilbert curve over their leading
principal axes (fitted on at most ``MAX_SAMPLE`` rows) and written as blocks of ``BLOCK_ROWS``; each block
carries the least and greatest value of every dimension of the rotated vectors, its zone.  The inner
product of an anchor with any row of a block lies within the interval that the zone gives:
a sum over dimensions, each at one end or the other.  Anchors travel in bundles along the same curve.

1. Each anchor reads its home block: the fifth-best row of its label there is a floor.
2. It reads the blocks of its label whose upper bound reaches that floor: the positives are exact.
3. Each positive opens a window of scores.  The home block gives a floor for the tenth-best
   row of another label in it.
4. The anchor reads the blocks whose interval meets some window at or above its floor.

So nothing is missed, and what is read depends on how well the zones tell the rows apart; on
vectors without structure that is most blocks.  Bounds are widened by more than rounding can do
(the products themselves are exact whole numbers).

Rows without id, label or vector, and vectors holding NULL or non-finite components, take no part;
of repeated ids the least (vector, label) counts; of vectors of different lengths those of the
commonest length count (the longer of equals).  Equal vectors of one label are one row with its
smallest ids, as many as any result can need, so a group of copies costs one row.

The tables of asks, bundles and blocks are joined by sorted shuffles whatever their files weigh (see ``_met``).
"""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from trainlake.llm.common import cut, map_arrow, slots

SCALE = 256
#: Most rows the axes are fitted on (drawn by a hash of the id); axes and bits of the curve.
MAX_SAMPLE, AXES, BITS = 20_000, 8, 8
#: Rows of a block, blocks of a zone pack, anchors of a bundle.
BLOCK_ROWS, PACK_BLOCKS, BUNDLE_ANCHORS = 512, 64, 512
#: Blocks or bundles of a part, if there are not more than the session's parts can hold.
PART_GROUPS = 4
_NONE = np.iinfo(np.int64).min


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of whole numbers below ``2 ** bits``; ``bits`` times columns is at most 64.

    Level by level, from the highest bit down: a cell's corner within its parent, seen from where the curve
    enters there, gives the next digits; the corner then says how the curve is turned and mirrored inside.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        low = bit - one
        for axis in range(n):
            mirrored = (x[axis] & bit) != 0
            swap = np.where(mirrored, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(mirrored, low, swap)
            x[axis] ^= swap
    # corners are numbered so that neighbours differ in one axis
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        flip ^= np.where((x[n - 1] & bit) != 0, bit - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << one) | ((x[axis] >> np.uint64(level)) & one)
    return key


class Axes:
    """A rotation onto principal axes, and the cells of the leading ones."""

    def __init__(self, sample: np.ndarray, axes: int = AXES, bits: int = BITS):
        self.bits = bits
        d = sample.shape[1]
        centred = sample - sample.mean(axis=0) if len(sample) else sample
        self.rotation = np.linalg.eigh(centred.T @ centred)[1][:, ::-1] if len(sample) else np.eye(d)
        self.axes = min(axes, d)
        seen = sample @ self.rotation[:, : self.axes]
        self.low = seen.min(axis=0) if len(sample) else np.zeros(self.axes)
        spread = seen.max(axis=0) - self.low if len(sample) else np.ones(self.axes)
        self.step = np.where(spread > 0, spread, 1.0) / (1 << bits)

    def keys(self, x: np.ndarray) -> np.ndarray:
        """Curve places, as signed numbers in curve order."""
        at = (x @ self.rotation[:, : self.axes] - self.low) / self.step
        cells = np.clip(np.floor(at), 0, (1 << self.bits) - 1).astype(np.uint64)
        return (hilbert_keys(cells, self.bits) ^ np.uint64(1 << 63)).view(np.int64)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray, margin: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``q`` with anything in each zone, a little widened."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    least = plus @ low.T + minus @ high.T
    greatest = plus @ high.T + minus @ low.T
    slack = 0.5 + margin * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T)
    return least - slack, greatest + slack


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact whole-number inner products, rows of ``q`` by rows of ``x``."""
    bound = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(x.shape[1], 1)
    return (q @ x.T).astype(np.int64) if bound < 2**53 else q.astype(np.int64) @ x.astype(np.int64).T


def _doubles(blob: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(rows, -1)


def labelled_vectors(embeddings: DataFrame, label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, x``: packed whole numbers (as doubles) of the rows that take part."""
    label = F.col("label") if label is None else label
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(math.inf))))
    rows = cut(rows.groupBy("vec_id").agg(F.min(F.struct("x", "label")).alias("r")).select("vec_id", "r.x", "r.label"))
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()

    def pack(batch: pa.RecordBatch):
        x = batch.column("x")
        flat = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.empty((0, 1))
        whole = np.floor(scale * flat) + 0.0
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([r.tobytes() for r in whole], pa.binary())], ["vec_id", "label", "x"])

    return map_arrow(rows.where(F.size("x") == (usual["d"] if usual else 0)).select("vec_id", "label", "x"), pack, "vec_id LONG, label LONG, x BINARY")


def _matrix(column) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1) if blobs else np.empty((0, 1))


class HardNegatives:
    """Blocks, zones and anchors of one table; ``mined()`` runs the four rounds."""

    def __init__(
        self, rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
        block_rows: int = BLOCK_ROWS, bundle_anchors: int = BUNDLE_ANCHORS,
    ):
        self.spark, self.positives, self.negatives, self.window = rows.sparkSession, positives, negatives, window
        self.read: dict[str, int] = {}
        points = cut(rows)
        n = points.count()
        drawn = points.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, MAX_SAMPLE / max(n, 1))) + (n <= MAX_SAMPLE))
        self.axes = self.spark.sparkContext.broadcast(Axes(_matrix(drawn.select("x").toArrow().column("x"))))
        most = max(negatives, positives + 1)
        ranked = points.withColumn("n", F.row_number().over(Window.partitionBy("x", "label").orderBy("vec_id"))).where(F.col("n") <= most)
        same = cut(ranked.groupBy("x", "label").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
        self.blocks = cut(self._along_curve(same, n, "id LONG, label LONG, x BINARY, ids ARRAY<LONG>", _block, "block LONG, n LONG, id BINARY, label BINARY, many BINARY, ids BINARY, x BINARY, low BINARY, high BINARY", block_rows))
        home = _unpacked(self.blocks, "block", "id").select("block", F.col("id").alias("home_id"))
        own = _met(_met(points.where(anchors), same.select("x", "label", F.col("id").alias("home_id")), ["x", "label"]), home, "home_id")
        self.bundles = cut(self._along_curve(own.select("vec_id", "label", "x", "block"), points.where(anchors).count(), "vec_id LONG, label LONG, x BINARY, block LONG", _bundle, "bundle LONG, anchor BINARY, label BINARY, home BINARY, q BINARY", bundle_anchors))
        self.packs = cut(self._packed_zones())

    def _along_curve(self, rows: DataFrame, most: int, schema: str, made, out: str, size: int) -> DataFrame:
        """``made`` of each ``size`` consecutive rows (``most`` at most) in curve order; equal places are dealt by a hash, so none is too many for a part.

        A part holds some ``PART_GROUPS`` groups: shorter ones, for the sake of more parts, would be as many more asks.
        """
        axes, names = self.axes, [f.split()[0] for f in schema.split(", ")]

        def place(batch: pa.RecordBatch):
            key = axes.value.keys(_matrix(batch.column("x"))) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "key"])

        def group(batches):
            part, number, held = TaskContext.get().partitionId(), 0, []
            for batch in batches:
                held.append(batch)
                while sum(b.num_rows for b in held) >= size:
                    rows = pa.Table.from_batches(held)
                    yield made(part << 32 | number, rows.slice(0, size), axes.value)
                    number, held = number + 1, rows.slice(size).to_batches()
            if sum(b.num_rows for b in held):
                yield made(part << 32 | number, pa.Table.from_batches(held), axes.value)

        first = names[0]
        keyed = map_arrow(rows.select(*names), place, f"{schema}, key LONG").withColumn("spread", F.xxhash64(first))
        parts = min(slots(self.spark), max(1, math.ceil(most / (size * PART_GROUPS))))
        ordered = keyed.repartitionByRange(parts, "key", "spread").sortWithinPartitions("key", "spread").select(*names)
        return ordered.mapInArrow(group, out)

    def _packed_zones(self) -> DataFrame:
        """Zones of up to ``PACK_BLOCKS`` consecutive blocks side by side, with the labels that each holds."""

        def group(batches):
            held = []
            for batch in batches:
                for i in range(batch.num_rows):
                    labels = np.unique(np.frombuffer(batch.column("label")[i].as_py(), np.int64))
                    held.append((batch.column("block")[i].as_py(), batch.column("low")[i].as_py(), batch.column("high")[i].as_py(), labels))
                    if len(held) == PACK_BLOCKS:
                        yield _pack(held)
                        held = []
            if held:
                yield _pack(held)

        zones = self.blocks.select("block", "low", "high", "label")
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(slots(self.spark))).alias("salt")
        return zones.mapInArrow(group, "blocks BINARY, low BINARY, high BINARY, kinds BINARY, labels BINARY").select(salt, "*")

    def _met_packs(self, state: DataFrame) -> DataFrame:
        """Each bundle with each pack: a copy of the bundles for each salt that occurs."""
        salts = [r["salt"] for r in self.packs.select("salt").distinct().collect()]  # no more than a shuffle's parts
        copies = state.select(F.explode(F.lit(salts).cast("array<long>")).alias("salt"), "*")
        return _met(copies, self.packs, "salt").drop("salt")

    def _asks(self, state: DataFrame, wanted, name: str) -> DataFrame:
        """``bundle, block, who``: the anchors (by number) of each bundle that must read a block, as ``wanted`` decides on zones."""
        axes = self.axes
        met = self._met_packs(state)

        def choose(batch: pa.RecordBatch):
            out = ([], [], [])
            for row in batch.to_pylist():
                blocks = np.frombuffer(row["blocks"], np.int64)
                low, high = _doubles(row["low"], len(blocks)), _doubles(row["high"], len(blocks))
                label, home = np.frombuffer(row["label"], np.int64), np.frombuffer(row["home"], np.int64)
                q = _doubles(row["q"], len(label)) @ axes.value.rotation
                least, greatest = bounds(q, low, high)
                kinds, ends = np.frombuffer(row["labels"], np.int64), np.cumsum(np.frombuffer(row["kinds"], np.int64))
                own = np.zeros(greatest.shape, bool)
                other = np.zeros(greatest.shape, bool)
                for b, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
                    own[:, b] = np.isin(label, kinds[start:end])
                    other[:, b] = end - start > own[:, b]
                ask = wanted(row, least, greatest, own, other) & (home[:, None] != blocks[None, :])
                for b in np.flatnonzero(ask.any(axis=0)).tolist():
                    for column, value in zip(out, (row["bundle"], int(blocks[b]), np.flatnonzero(ask[:, b]).astype(np.int64).tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["bundle", "block", "who"])

        asks = cut(map_arrow(met, choose, "bundle LONG, block LONG, who BINARY"))
        self.read[name] = asks.count()
        return asks

    def _homes(self) -> DataFrame:
        """``bundle, block, who``: every anchor at its home block."""

        def step(batch: pa.RecordBatch):
            out = ([], [], [])
            for bundle, home in zip(batch.column("bundle").to_pylist(), batch.column("home").to_pylist(), strict=True):
                home = np.frombuffer(home, np.int64)
                for block in np.unique(home).tolist():
                    for column, value in zip(out, (bundle, block, np.flatnonzero(home == block).astype(np.int64).tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["bundle", "block", "who"])

        return map_arrow(self.bundles.select("bundle", "home"), step, "bundle LONG, block LONG, who BINARY")

    def _read(self, asks: DataFrame, state: DataFrame, look, schema: str) -> DataFrame:
        """``look(state row, anchors, block, scores)`` of every anchor with every block it asked for."""
        blocks = self.blocks.select("block", "n", F.col("id").alias("ids_"), F.col("label").alias("labels_"), "many", "ids", "x")
        met = _met(_met(asks, state, "bundle"), blocks, "block")

        def step(batch: pa.RecordBatch):
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                who = np.frombuffer(row["who"], np.int64)
                label = np.frombuffer(row["label"], np.int64)
                scores = _products(_doubles(row["q"], len(label))[who], _doubles(row["x"], row["n"]))
                yield look(row, who, _Block(row), scores)

        return map_arrow(met, step, schema)

    def mined(self) -> DataFrame:
        """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
        k, m = self.positives, self.negatives
        low, high = self.window
        found = "bundle LONG, who LONG, ids ARRAY<LONG>, score LONG"

        def same_label(row, who, block, scores):
            anchor, label = np.frombuffer(row["anchor"], np.int64), np.frombuffer(row["label"], np.int64)
            floor = np.frombuffer(row["floor"], np.int64) if "floor" in row else np.full(len(anchor), _NONE)
            out = ([], [], [], [])
            for j, i in enumerate(who.tolist()):
                rows = np.flatnonzero((block.label == label[i]) & (scores[j] >= floor[i]))
                rows = rows[np.lexsort((block.id[rows], -scores[j, rows]))[: k + 1]]
                for r in rows.tolist():
                    ids = block.ids(r)
                    if ids := [x for x in ids if x != anchor[i]][:k]:
                        for column, value in zip(out, (row["bundle"], i, ids, int(scores[j, r])), strict=True):
                            column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.int64())], ["bundle", "who", "ids", "score"])

        homes = cut(self._homes())
        at_home = cut(self._read(homes, self.bundles, same_label, found))
        floors = _best(at_home, ["bundle", "who"], k).where(F.col("rank") == k).select("bundle", "who", F.col("score").alias("floor"))
        state = cut(self._with(self.bundles, floors, "floor"))

        def near(row, least, greatest, own, other):
            return own & (greatest >= np.frombuffer(row["floor"], np.int64)[:, None])

        positives = cut(_best(at_home.unionByName(self._read(self._asks(state, near, "positives"), state, same_label, found)), ["bundle", "who"], k))

        windows = cut(self._windows(positives))

        def in_windows(row, who, block, scores):
            label, (tops, bottoms) = np.frombuffer(row["label"], np.int64), _open_windows(row, k)
            out = ([], [], [], [], [])
            for j, i in enumerate(who.tolist()):
                open_ = np.flatnonzero(bottoms[i] <= tops[i]).tolist()
                if not open_:
                    continue
                rows = np.flatnonzero((block.label != label[i]) & (scores[j] >= bottoms[i, open_].min()) & (scores[j] <= tops[i, open_].max()))
                rows = rows[np.lexsort((block.id[rows], -scores[j, rows]))]
                falling = -scores[j, rows]
                for w in open_:
                    a, b = np.searchsorted(falling, -tops[i, w]), np.searchsorted(falling, -bottoms[i, w], "right")
                    for r in rows[a : min(b, a + m)].tolist():
                        for column, value in zip(out, (row["bundle"], i, w, block.ids(r), int(scores[j, r])), strict=True):
                            column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.int64())], ["bundle", "who", "w", "ids", "score"])

        seen = "bundle LONG, who LONG, w LONG, ids ARRAY<LONG>, score LONG"
        no_floors = self.spark.createDataFrame([], "bundle LONG, who LONG, floor LONG")
        at_home = cut(self._read(homes, self._with(windows, no_floors, "floor", k), in_windows, seen))
        floors = _best(at_home, ["bundle", "who", "w"], m).where(F.col("rank") == m).select("bundle", (F.col("who") * k + F.col("w")).alias("who"), F.col("score").alias("floor"))
        state = cut(self._with(windows, floors, "floor", k))

        def meets(row, least, greatest, own, other):
            tops, bottoms = _open_windows(row, k)
            ask = np.zeros(greatest.shape, bool)
            for w in range(k):
                fits = bottoms[:, w] <= tops[:, w]
                ask |= fits[:, None] & (greatest >= bottoms[:, w : w + 1]) & (least <= tops[:, w : w + 1])
            return ask & other

        negatives = at_home.unionByName(self._read(self._asks(state, meets, "negatives"), state, in_windows, seen))
        best = _best(negatives, ["bundle", "who", "w"], m).withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
        pairs = positives.select("bundle", "who", (F.col("rank") - 1).cast("long").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        names = _unpacked(self.bundles, "bundle", "anchor").withColumnRenamed("anchor", "anchor_id")
        rows = _met(best, _met(pairs, names, ["bundle", "who"]), ["bundle", "who", "w"])
        return rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

    def _with(self, bundles: DataFrame, values: DataFrame, name: str, each: int = 1, default: int = _NONE) -> DataFrame:
        """The bundles with one more packed column: a value for each of ``each`` places of each anchor, or the default."""
        held = values.groupBy("bundle").agg(F.collect_list(F.struct("who", name)).alias("held"))
        kept = list(bundles.schema.fields)

        def pack(batch: pa.RecordBatch):
            made = []
            for label, held in zip(batch.column("label").to_pylist(), batch.column("held").to_pylist(), strict=True):
                column = np.full(len(label) // 8 * each, default)
                for h in held or ():
                    column[h["who"]] = h[name]
                made.append(column.tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(made, pa.binary())], [*(f.name for f in kept), name])

        return map_arrow(_met(bundles, held, "bundle", "left"), pack, StructType([*kept, StructField(name, BinaryType())]))

    def _windows(self, positives: DataFrame) -> DataFrame:
        """The bundles with the last and first score of each positive's window; a missing positive's is empty."""
        low, high = self.window
        place = (F.col("who") * self.positives + F.col("rank") - 1).alias("who")
        top = F.expr(f"({high} * score - pmod({high} * score, 100)) div 100").alias("tops")
        bottom = F.expr(f"-(({-low} * score - pmod({-low} * score, 100)) div 100)").alias("bottoms")
        ended = self._with(self.bundles, positives.select("bundle", place, top), "tops", self.positives)
        return self._with(ended, positives.select("bundle", place, bottom), "bottoms", self.positives, np.iinfo(np.int64).max)


def _open_windows(row: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest and least score of each of the ``k`` windows of each anchor; none below its floor is needed any more."""
    tops, bottoms, floors = (np.frombuffer(row[c], np.int64).reshape(-1, k) for c in ("tops", "bottoms", "floor"))
    return tops, np.maximum(bottoms, floors)


class _Block:
    """The rows of a block as they came with an ask."""

    def __init__(self, row: dict):
        self.id, self.label = np.frombuffer(row["ids_"], np.int64), np.frombuffer(row["labels_"], np.int64)
        self._ids, self._ends = np.frombuffer(row["ids"], np.int64), np.cumsum(np.frombuffer(row["many"], np.int64))

    def ids(self, r: int) -> list[int]:
        return self._ids[self._ends[r - 1] if r else 0 : self._ends[r]].tolist()


def _met(rows: DataFrame, others: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by sorted shuffles, with few ``others`` a key.

    Packed columns that repeat weigh next to nothing in a file, and copies made on the way nothing at all; Spark goes
    by the files' size, so it would have the driver hold and broadcast tables of hundreds of times that.
    """
    return rows.join(others.hint("merge"), on, how)


def _unpacked(rows: DataFrame, key: str, column: str) -> DataFrame:
    """``key, who, column``: the longs of a packed column, numbered from 0."""

    def step(batch: pa.RecordBatch):
        values = [np.frombuffer(b, np.int64) for b in batch.column(column).to_pylist()]
        sizes = [len(v) for v in values]
        row = np.repeat(np.arange(len(values)), sizes)
        place = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.empty(0, np.int64)
        flat = np.concatenate(values) if values else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(row)), pa.array(place, pa.int64()), pa.array(flat)], [key, "who", column])

    return map_arrow(rows.select(key, column), step, f"{key} LONG, who LONG, {column} LONG")


def _best(rows: DataFrame, key: list[str], k: int) -> DataFrame:
    """``*key, rank, id, score`` of the ``k`` highest scores, ties to smaller ids."""
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), F.element_at("ids", 1)))).where(F.col("n") <= k)
    each = first.select(*key, F.explode("ids").alias("id"), "score")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(*key, "rank", "id", "score")


def _block(number: int, rows: pa.Table, axes: Axes) -> pa.RecordBatch:
    x = _matrix(rows.column("x"))
    seen = x @ axes.rotation
    ids = rows.column("ids").to_pylist()
    blobs = [
        rows.column("id").to_numpy().tobytes(), rows.column("label").to_numpy().tobytes(), np.array([len(i) for i in ids], np.int64).tobytes(),
        np.array([v for i in ids for v in i], np.int64).tobytes(), x.tobytes(), seen.min(axis=0).tobytes(), seen.max(axis=0).tobytes(),
    ]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([len(x)], pa.int64()), *(pa.array([b], pa.binary()) for b in blobs)], ["block", "n", "id", "label", "many", "ids", "x", "low", "high"])


def _bundle(number: int, rows: pa.Table, axes: Axes) -> pa.RecordBatch:
    blobs = [*(rows.column(c).to_numpy().tobytes() for c in ("vec_id", "label", "block")), b"".join(rows.column("x").to_pylist())]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([b], pa.binary()) for b in blobs)], ["bundle", "anchor", "label", "home", "q"])


def _pack(held: list) -> pa.RecordBatch:
    blobs = [
        np.array([h[0] for h in held], np.int64).tobytes(), b"".join(h[1] for h in held), b"".join(h[2] for h in held),
        np.array([len(h[3]) for h in held], np.int64).tobytes(), np.concatenate([h[3] for h in held]).tobytes(),
    ]
    return pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], ["blocks", "low", "high", "kinds", "labels"])


def hard_negatives(embeddings: DataFrame, anchors: Column, label: Column | None = None, **options) -> DataFrame:
    """For each anchor (a condition on ``vec_id``) and each of its best rows of the same label, the best rows of
    other labels whose score lies within the window of percentages of the positive's."""
    return HardNegatives(labelled_vectors(embeddings, label), anchors, **options).mined()
