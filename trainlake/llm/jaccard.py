"""Jaccard self-join on word shingles by prefix filters under several global orders.

Sets with a Jaccard similarity of ``t`` or more share a token among the first
``n - ceil(t n) + 1`` of each, under *every* total order of the tokens.  So a pair is a
candidate only if it shares a prefix token under the first order, and then under each
further one, before its sets are compared.  A prefix token counts only where it can be the first the two
share: the tokens after it in both orders must suffice for the similarity.  The further filters take prefixes longer by a tenth of the
set and ask for that many shared tokens, which similar sets have for the same reason.  All orders put frequent tokens last (by a
fixed-size table of counts) and break ties by hashes of their own.

Equal sets are one class from the start.  The list of a prefix token is sorted by the size of the sets;
each member is compared with the ``BACK`` before it and with the first, which are all pairs of most
lists.  For longer ones, components of these links are then settled, and what
remains are pairs of *different* components, of which the smaller ones are compared with
all others of the list; where a list is long, only those whose parity sketches allow the similarity, and
with a few drawn rows of it first, as one link of the many that a straggler has with a large group will do.
So a large group of near copies costs its size, not its square,
and no link between components is missed.  Lists and classes that are hot by a fixed-size table of
counts are dealt out in parts.

Rows are told apart by id and text.  A class is named by its least id, or, if it has none or another class
has it too, by its 64-bit digest.  Tables and filters that have served are given back.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.llm.common import cut, map_arrow, mixed, release, rolled, scratch, slots, text_bytes, word_bounds, word_hashes
from trainlake.llm.components import components
from trainlake.llm.sketch import class_of, counted, frequency_classes, members

SHINGLE, PERCENT = 5, 75
#: Orders after the first, used as filters on pairs.
FURTHER = 2
#: Members of a list that one is compared with besides the first; so lists of up to two more are done with.
BACK = 3
#: Rows of a list from which on sketches are compared before pairs are formed, and 64-bit words of a sketch.
LONG_LIST, SKETCH_WORDS = 32, 8
#: Bytes of a sketch and the size of its set.
HEAD = 8 * SKETCH_WORDS + 4
#: Rows drawn of a long list's largest component, and of its others, that all of its rows are compared with first.
DRAWN = 16
#: Cells of the tables of counts by which hot lists and classes are found, and rows of one part.
LOG_HOT, PART = 16, 4096
#: Sizes of the filters of classes that are not named by an id, and of classes in play.
LOG_ODD, LOG_NODES = 20, 23
#: Stands for a missing id.
NO_ID = -(2**63)


def shingle_sets(batch: pa.RecordBatch, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: whole sequences where there are fewer words."""
    raw, offsets = text_bytes(batch.column("text"))
    starts, ends, first = word_bounds(raw, offsets)
    words = word_hashes(raw, starts, ends, 0, lower=True)
    grams = rolled(words, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(mixed(rolled(words[a:b], b - a), 20 + b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _more(n: int) -> int:
    """Tokens that prefixes for the further orders are longer by, and that similar sets then share at least."""
    return -(-n // 10)


def _ordered(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """Tokens by frequency class, then by a hash of the order's own."""
    return tokens[np.lexsort((mixed(tokens, 300 + order), class_of(tokens, classes)))]


def _cells(column: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in column], pa.binary())


def _digests_of(sets: list[np.ndarray], which: int) -> np.ndarray:
    return np.array([int(mixed(s, which).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)


def _named(doc: np.ndarray, d1: np.ndarray) -> np.ndarray:
    """A hash of a row's id and its set."""
    return mixed(doc.view(np.uint64) ^ mixed(d1.view(np.uint64), 71), 72)


def _parts(rows: DataFrame, column: str) -> DataFrame:
    """``cell, parts``: into how many parts the rows of each cell of a column are dealt; one row a cell at most."""
    cells = 1 << LOG_HOT
    counts = rows.groupBy(F.pmod(F.col(column), F.lit(cells)).alias("cell")).agg(F.count("*").alias("many"))
    usual = rows.count() // cells
    return cut(counts.select("cell", F.ceil(F.col("many") / max(PART, 4 * usual)).alias("parts")).where("parts > 1"))


def _dealt(rows: DataFrame, column: str, by: Column, parts: DataFrame) -> DataFrame:
    """The rows with their ``part``, and how many ``parts`` there are where they are."""
    cell = F.pmod(F.col(column), F.lit(1 << LOG_HOT)).alias("cell")
    dealt = rows.select(cell, "*").join(F.broadcast(parts), "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    return dealt.withColumn("part", F.pmod(by, F.col("parts"))).drop("cell")


_LIST_ROWS = "kind INT, token LONG, a LONG, b LONG, n LONG, rest LONG"
_PAIR, _OPEN, _FIRST = range(3)


def _walk(batches, percent: int):
    """Rows sorted by token, part, size and id → pairs of neighbours that fit, rows of lists left open, firsts of split lists."""
    held = None
    for batch in batches:
        arrays = [batch.column(c).to_numpy() for c in ("token", "part", "rep", "n", "rest", "parts")]
        if held is not None:
            arrays = [np.concatenate(x) for x in zip(held, arrays, strict=True)]
        token, part = arrays[:2]
        if not len(token):
            continue
        # the last list may go on in the next batch
        last = np.flatnonzero((token != token[-1]) | (part != part[-1]))
        done = int(last[-1]) + 1 if len(last) else 0
        held = [x[done:] for x in arrays]
        if done:
            yield _compared([x[:done] for x in arrays], percent)
    if held is not None and len(held[0]):
        yield _compared(held, percent)


def _compared(arrays: list[np.ndarray], percent: int) -> pa.RecordBatch:
    token, part, rep, n, rest, parts = arrays
    new = np.r_[True, (token[1:] != token[:-1]) | (part[1:] != part[:-1])]
    first = np.flatnonzero(new)
    sizes = np.diff(np.r_[first, len(token)])
    at = np.repeat(first, sizes)
    place = np.arange(len(token)) - at
    ones, others = [], []
    for back in range(1, BACK + 1):
        i = np.flatnonzero(place >= back)
        ones.append(i - back)
        others.append(i)
    i = np.flatnonzero(place > BACK)
    ones.append(at[i])
    others.append(i)
    a, b = np.concatenate(ones), np.concatenate(others)
    fits = (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])) & ((100 + percent) * np.minimum(rest[a], rest[b]) >= percent * (n[a] + n[b])) & (rep[a] != rep[b])
    a, b = rep[a[fits]], rep[b[fits]]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    # a list in parts is open as a whole, and the firsts of its parts are compared next
    rows = np.flatnonzero(np.repeat((sizes > BACK + 2) | (parts[first] > 1), sizes))
    split = first[parts[first] > 1]
    none = np.zeros(pairs.shape[1], np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([_PAIR, _OPEN, _FIRST], [len(none), len(rows), len(split)]).astype(np.int32)),
            *(pa.array(np.concatenate(c)) for c in ((none, token[rows], token[split]), (pairs[0], rep[rows], rep[split]), (pairs[1], rep[rows], rep[split]), (none, n[rows], n[split]), (none, rest[rows], rest[split]))),
        ],
        ["kind", "token", "a", "b", "n", "rest"],
    )


class JaccardJoin:
    """The join over ``documents(doc_id, text)``."""

    def __init__(self, documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE):
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
        self.rows = documents.select(doc.alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))
        self.percent, self.size, self.spark = percent, size, documents.sparkSession
        self._shared: list = []
        self._made: list[tuple[DataFrame, str]] = []
        self.classes, self.odd = self._classed()

    # -- tables and filters for a while ---

    def _cut(self, df: DataFrame) -> DataFrame:
        """A written table that ``_free`` gives back."""
        path = scratch(self.spark)
        made = cut(df, path)
        self._made.append((made, path))
        return made

    def _share(self, value):
        shared = self.spark.sparkContext.broadcast(value)
        self._shared.append(shared)
        return shared

    def _free(self, *tables: DataFrame) -> None:
        """Give back these written tables; only where nothing reads them any more."""
        for made, path in [m for m in self._made if any(m[0] is t for t in tables)]:
            release(made, path)
        self._made = [m for m in self._made if not any(m[0] is t for t in tables)]

    def _unshare(self, *but) -> None:
        """Destroy the filters that are out, but those; only where all that used them is written."""
        for shared in self._shared:
            if not any(shared is b for b in but):
                shared.destroy()
        self._shared = list(but)

    # -- classes of equal sets ---

    def _classed(self):
        """``doc, mark, n, d1, rep, node`` of each row, and the filter of the classes that are not named by an id.

        ``rep`` is the least id of an equal set (``NO_ID`` if there is none); rows without words are classes of their own.
        """
        size = self.size

        def step(batch: pa.RecordBatch):
            sets = shingle_sets(batch, size)
            d = [pa.array(_digests_of(sets, k)) for k in (31, 32)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int64()), *d], ["doc", "mark", "n", "d1", "d2"])

        digests = self._cut(map_arrow(self.rows, step, "doc LONG, mark LONG, n LONG, d1 LONG, d2 LONG"))
        sets = digests.where("n > 0")
        known = F.when(F.col("doc") != NO_ID, F.col("doc"))
        reps = self._cut(sets.groupBy("n", "d1", "d2").agg(F.coalesce(F.min(known), F.lit(NO_ID)).alias("rep")))
        several = reps.where(F.col("rep") != NO_ID).groupBy("rep").agg(F.count("*").alias("many")).where("many > 1").select("rep")
        unnamed = reps.select("rep", "d1").join(several, "rep", "left_semi").union(reps.where(F.col("rep") == NO_ID).select("rep", "d1"))
        unnamed = self._cut(unnamed)
        odd = counted(unnamed, lambda b: _named(b.column("rep").to_numpy(), b.column("d1").to_numpy()), 1, LOG_ODD)
        self.odd_ids = counted(unnamed, lambda b: b.column("rep").to_numpy().view(np.uint64), 1, LOG_ODD)
        shared = self._share(odd)

        def name(batch: pa.RecordBatch):
            rep, d1 = batch.column("rep").to_numpy(), batch.column("d1").to_numpy()
            node = np.where(shared.value.holds(_named(rep, d1)), d1, rep)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node)], [*batch.schema.names, "node"])

        # a hot class meets its name in parts
        parts = _parts(sets, "d1")
        names = reps.select(F.pmod("d1", F.lit(1 << LOG_HOT)).alias("cell"), "*").join(F.broadcast(parts), "cell", "left")
        last = F.coalesce("parts", F.lit(1)) - 1
        names = names.select("n", "d1", "d2", "rep", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("part"))
        named = _dealt(sets, "d1", F.xxhash64(F.monotonically_increasing_id()), parts)
        named = named.join(names, ["n", "d1", "d2", "part"]).select("doc", "mark", "n", "d1", "rep")
        empty = digests.where("n = 0").select("doc", "mark", "n", "d1", F.col("doc").alias("rep"))
        classes = cut(map_arrow(named.unionByName(empty), name, "doc LONG, mark LONG, n LONG, d1 LONG, rep LONG, node LONG"))
        self._free(digests, reps, unnamed)
        self._unshare()
        return classes, odd

    def _copied(self):
        """The rows (by id and set) that stand not for their class, or more than once, and their filter."""
        copies = self.classes.where("n > 0").groupBy("doc", "d1").agg(F.count("*").alias("many"), F.first("rep").alias("rep")).where("doc <> rep OR many > 1")
        copies = self._cut(copies.select("doc", "d1", (F.col("doc") != F.col("rep")).alias("copy")))
        return copies, counted(copies, lambda b: _named(b.column("doc").to_numpy(), b.column("d1").to_numpy()), 1, LOG_NODES)

    def _each(self, value_of, name: str, wanted=None) -> tuple[DataFrame, DataFrame]:
        """``node, n, <name>``: ``value_of`` the sets of one row per class (of those wanted), and the written table behind it."""
        size, odd, odd_ids, copied = self.size, *map(self._share, (self.odd, self.odd_ids, self.copied))

        def step(batch: pa.RecordBatch):
            if wanted is not None:
                doc = batch.column("doc").to_numpy().view(np.uint64)
                batch = batch.filter(pa.array(wanted.value.holds(doc) | odd_ids.value.holds(doc)))
            doc, sets = batch.column("doc").to_numpy(), shingle_sets(batch, size)
            d1 = _digests_of(sets, 31)
            named = _named(doc, d1)
            node = np.where(odd.value.holds(named), d1, doc)
            keep = np.array([len(s) > 0 for s in sets], bool)
            if wanted is not None:
                keep &= wanted.value.holds(node.view(np.uint64))
            values = pa.array([value_of(s) if k else b"" for s, k in zip(sets, keep.tolist(), strict=True)], pa.binary())
            columns = [pa.array(doc), pa.array(d1), pa.array(node), pa.array([len(s) for s in sets], pa.int64()), values, pa.array(copied.value.holds(named))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "d1", "node", "n", name, "unsure"]).filter(pa.array(keep))

        made = self._cut(map_arrow(self.rows.select("doc", "text"), step, f"doc LONG, d1 LONG, node LONG, n LONG, {name} BINARY, unsure BOOLEAN"))
        unsure = made.where("unsure").dropDuplicates(["doc", "d1"]).join(self.copies.where("copy").select("doc", "d1"), ["doc", "d1"], "left_anti")
        return made.where("not unsure").select("node", "n", name).union(unsure.select("node", "n", name)), made

    def _postings(self, table) -> DataFrame:
        """``token, rep, n, rest`` (how many tokens of the set don't come before it) for prefix tokens that some other class may have in its prefix too."""
        percent = self.percent
        prefixes, behind = self._each(lambda s: _ordered(s, table.value, 0)[: _prefix(len(s), percent)].tobytes(), "prefix")
        twice = self._share(counted(prefixes.select("prefix"), lambda b: np.frombuffer(b"".join(b.column("prefix").to_pylist()), np.uint64)))

        def step(batch: pa.RecordBatch):
            blobs = batch.column("prefix").to_pylist()
            tokens = np.frombuffer(b"".join(blobs), np.uint64)
            sizes = np.array([len(x) // 8 for x in blobs], np.int64)
            row = np.repeat(np.arange(len(blobs)), sizes)
            rest = batch.column("n").to_numpy()[row] - (np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
            keep = twice.value.holds(tokens)
            tokens, row, rest = tokens[keep], pa.array(row[keep]), rest[keep]
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), batch.column("node").take(row), batch.column("n").take(row), pa.array(rest)], ["token", "rep", "n", "rest"])

        postings = self._cut(map_arrow(prefixes.select("prefix", "node", "n"), step, "token LONG, rep LONG, n LONG, rest LONG"))
        self._free(behind)
        self._unshare(table)
        return postings

    def _lists(self, postings: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs (a, b) of neighbours in the lists that fit, and the rows of lists that these don't settle.

        They fit if sizes, and the tokens left from the shared one on, allow the similarity: with ``o`` tokens in
        common, ``100 o`` is at least ``percent`` of ``na + nb - o``.
        """
        percent = self.percent

        def compared(rows: DataFrame) -> DataFrame:
            dealt = rows.repartition(slots(self.spark), "token", "part").sortWithinPartitions("token", "part", "n", "rep")
            return self._cut(dealt.select("token", "part", "rep", "n", "rest", "parts").mapInArrow(lambda batches: _walk(batches, percent), _LIST_ROWS))

        found = [compared(_dealt(postings, "token", F.xxhash64("rep"), _parts(postings, "token")))]
        # the firsts of the parts of a list are a list again
        found.append(compared(found[0].where(f"kind = {_FIRST}").select("token", F.lit(0).cast("long").alias("part"), F.col("a").alias("rep"), "n", "rest", F.lit(1).cast("long").alias("parts"))))
        pairs = self._cut(found[0].where(f"kind = {_PAIR}").union(found[1].where(f"kind = {_PAIR}")).select("a", "b").distinct())
        open_ = self._cut(found[0].where(f"kind = {_OPEN}").select("token", F.col("a").alias("rep"), "n", "rest"))
        self._free(postings, *found)
        return pairs, open_

    def _fits(self):
        """As in ``_lists``, for columns ``na, ra, nb, rb``."""
        sizes = F.lit(100) * F.least("na", "nb") >= F.lit(self.percent) * F.greatest("na", "nb")
        return sizes & (F.lit(100 + self.percent) * F.least("ra", "rb") >= F.lit(self.percent) * (F.col("na") + F.col("nb")))

    def _among(self, nodes: DataFrame):
        """A filter that holds all of ``nodes(rep)``."""
        return self._share(members(nodes, "rep", LOG_NODES))

    def _marks(self, pairs: DataFrame, open_: DataFrame, table) -> DataFrame:
        """``node, n, marks``: those of the prefixes under further orders, of all classes that may be in a pair."""
        percent = self.percent
        wanted = self._among(pairs.select(F.explode(F.array("a", "b")).alias("rep")).union(open_.select("rep")))

        def marks(s: np.ndarray) -> bytes:
            return _marked([_ordered(s, table.value, o)[: _prefix(len(s), percent) - 1 + _more(len(s))] for o in range(1, FURTHER + 1)], s)

        return self._each(marks, "marks", wanted)

    def _sketches(self, nodes: DataFrame, marks: DataFrame) -> DataFrame:
        """``rep, sketch`` (an array of longs) of the nodes, and perhaps some others."""
        asked = self._among(nodes.select("rep"))

        def step(batch: pa.RecordBatch):
            batch = batch.filter(pa.array(asked.value.holds(batch.column("node").to_numpy().view(np.uint64)), pa.bool_()))
            words = [np.frombuffer(b, "<i8", SKETCH_WORDS).tolist() for b in batch.column("marks").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(words, pa.list_(pa.int64()))], ["rep", "sketch"])

        return map_arrow(marks.select("node", "marks"), step, "rep LONG, sketch ARRAY<LONG>")

    def _unsettled(self, open_: DataFrame, links: DataFrame) -> DataFrame:
        """``token, rep, n, rest, component, main, length`` of the lists that still hold several components; ``main`` is the largest."""
        found = cut(components(links))
        placed = open_.join(found, F.col("rep") == F.col("node"), "left").select("token", "rep", "n", "rest", F.coalesce("component", "rep").alias("component"))
        sizes = placed.groupBy("token", "component").agg(F.count("*").alias("many"))
        main = sizes.groupBy("token").agg(F.max_by("component", F.struct("many", "component")).alias("main"), F.count("*").alias("kinds"), F.sum("many").alias("length"))
        return self._cut(placed.join(main.where("kinds > 1").drop("kinds"), "token"))

    def _long(self, left: DataFrame, marks: DataFrame) -> DataFrame:
        """The rows of long lists with their sketches."""
        long = left.where(F.col("length") > LONG_LIST)
        return self._cut(long.join(self._sketches(long, marks), "rep"))

    def _drawn(self, rows: DataFrame) -> DataFrame:
        """A few rows of each list's largest component and a few of the others, by a hash that is the same in all lists."""
        order = Window.partitionBy("token", F.col("component") == F.col("main")).orderBy(F.xxhash64("rep"), "rep")
        return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= DRAWN).drop("place")

    def _crossing(self, rows: DataFrame, sketched: bool, others: DataFrame | None = None) -> DataFrame:
        """Pairs (a, b) of ``rows`` and ``others`` (or ``rows``) in one list, of different components of which one is not the list's largest, that fit."""
        few, all_ = (
            side.select("token", F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("rest").alias(f"r{x}"), F.col("component").alias(f"c{x}"), "main", *([F.col("sketch").alias(f"s{x}")] if sketched else []))
            for x, side in zip("ab", (rows, rows if others is None else others), strict=True)
        )
        meets = (few["token"] == all_["token"]) & (F.col("ca") != F.col("cb")) & self._fits()
        if sketched:
            apart = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
            # of na + nb tokens at most this share may differ
            meets &= (100 + self.percent) * apart <= (100 - self.percent) * (F.col("na") + F.col("nb"))
        met = few.where("ca <> main").drop("main").join(all_.drop("main"), meets)
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def _joined(self, pairs: DataFrame, own: DataFrame, name: str) -> DataFrame:
        """Pairs with a packed column of both sides, first ``x`` and ``y``; those that are not at this end of a pair are left behind before the shuffle.

        Few pairs are not broadcast: a task would then run this filter and the comparison that follows at once, in two Python workers.
        """

        def side(end: str, value: str) -> DataFrame:
            asked = self._share(members(pairs, end, LOG_NODES))

            def step(batch: pa.RecordBatch):
                yield batch.filter(pa.array(asked.value.holds(batch.column("node").to_numpy().view(np.uint64)), pa.bool_()))

            rows = map_arrow(own.select("node", name), step, f"node LONG, {name} BINARY")
            return rows.select(F.col("node").alias(end), F.col(name).alias(value))

        return pairs.join(side("a", "x").hint("merge"), "a").join(side("b", "y").hint("merge"), "b").select("x", "y", "a", "b")

    def _verified(self, pairs: DataFrame, marks: DataFrame) -> DataFrame:
        """Of candidate pairs (a, b) those that pass the sketches, then all further orders and then the comparison of whole sets; written."""
        percent = self.percent

        def near(batch: pa.RecordBatch):
            ok = [_near(x, y, percent) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

        def agree(batch: pa.RecordBatch):
            ok = [_share_all(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

        heads = marks.select("node", F.substring("marks", 1, HEAD).alias("head"))
        alike = self._cut(map_arrow(self._joined(pairs, heads, "head"), near, "a LONG, b LONG"))
        passed = self._cut(map_arrow(self._joined(alike, marks, "marks"), agree, "a LONG, b LONG"))
        self._unshare()
        wanted = self._among(passed.select(F.explode(F.array("a", "b")).alias("rep")))
        whole, behind = self._each(lambda s: s.tobytes(), "tokens", wanted)
        self._unshare()

        def compare(batch: pa.RecordBatch):
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

        links = cut(map_arrow(self._joined(passed, whole, "tokens"), compare, "a LONG, b LONG"))
        self._free(alike, passed, behind)
        self._unshare()
        return links

    def links(self) -> DataFrame:
        """``a, b``: linked pairs of classes (by ``node``); with ``classes`` they connect all that is linked, though
        not all pairs within a component are listed."""
        size = self.size
        table = self._share(frequency_classes(self.rows.select("text"), lambda b: _all(shingle_sets(b, size))))
        self.copies, self.copied = self._copied()
        pairs, open_ = self._lists(self._postings(table))
        marks, behind = self._marks(pairs, open_, table)
        self._unshare()
        links = self._verified(pairs, marks)
        # what a few rows of each long list tell, before all pairs are formed of what is left
        left = self._unsettled(open_, links)
        rows = self._long(left, marks)
        self._unshare()
        drawn = self._cut(self._crossing(rows, True, self._drawn(rows)).distinct().join(pairs, ["a", "b"], "left_anti"))
        links = cut(links.union(self._verified(drawn, marks)))
        self._free(left, rows)
        # lists that still hold several components: all but the largest against everything outside their own
        left = self._unsettled(open_, links)
        rows = self._long(left, marks)
        self._unshare()
        crossing = self._crossing(left.where(F.col("length") <= LONG_LIST), False).union(self._crossing(rows, True)).distinct()
        crossing = self._cut(crossing.join(pairs.union(drawn), ["a", "b"], "left_anti"))
        self._free(open_, left, rows)
        more = self._verified(crossing, marks)
        self._free(behind, pairs, drawn, crossing, self.copies)
        return links.union(more)

    def groups(self) -> DataFrame:
        """``doc, mark, n, rep, node, component, least`` of every row: its component's node, and the least id in it (``NO_ID`` if it has none)."""
        known = F.when(F.col("rep") != NO_ID, F.col("rep"))
        found = cut(components(self.links()))
        named = self.classes.select("node", "rep").distinct().join(found, "node")
        least = named.groupBy("component").agg(F.coalesce(F.min(known), F.lit(NO_ID)).alias("least"))
        placed = self.classes.join(found.join(least, "component"), "node", "left")
        return placed.select("doc", "mark", "n", "rep", "node", F.coalesce("component", "node").alias("component"), F.coalesce("least", "rep").alias("least"))


def _all(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(sets) if sets else np.empty(0, np.uint64)


def _sketch(tokens: np.ndarray) -> bytes:
    """Parities of the numbers of tokens in as many cells as there are bits.

    Where two sketches differ, the sets do, each difference in one cell at most.
    """
    bits = 64 * SKETCH_WORDS
    odd = np.bincount((mixed(tokens, 500) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _marked(prefixes: list[np.ndarray], tokens: np.ndarray) -> bytes:
    """The set's sketch, its size, then for each order the number of tokens and their 16-bit marks.

    Tokens may share a mark, so marks in common are never too few.
    """
    out = [_sketch(tokens), np.array([len(tokens)], "<u4").tobytes()]
    for order, tokens in enumerate(prefixes):
        out += [np.array([len(tokens)], "<u4").tobytes(), (mixed(tokens, 400 + order) >> np.uint64(48)).astype("<u2").tobytes()]
    return b"".join(out)


def _near(x: bytes, y: bytes, percent: int) -> bool:
    """Whether the sketches of two sets allow the similarity: of all their tokens at most this share may differ."""
    at = HEAD - 4
    apart = (int.from_bytes(x[:at], "little") ^ int.from_bytes(y[:at], "little")).bit_count()
    sizes = int.from_bytes(x[at:HEAD], "little") + int.from_bytes(y[at:HEAD], "little")
    return (100 + percent) * apart <= (100 - percent) * sizes


def _share_all(x: bytes, y: bytes) -> bool:
    """Whether two sets share enough marks under every further order."""
    i = j = HEAD
    needed = _more(min(int.from_bytes(x[i - 4 : i], "little"), int.from_bytes(y[j - 4 : j], "little")))
    while i < len(x):
        m, n = int.from_bytes(x[i : i + 4], "little"), int.from_bytes(y[j : j + 4], "little")
        a, b = np.frombuffer(x, "<u2", m, i + 4), np.frombuffer(y, "<u2", n, j + 4)
        if int(np.isin(a, b).sum()) < needed:
            return False
        i, j = i + 4 + 2 * m, j + 4 + 2 * n
    return True


def linked_groups(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Per document the size of its shingle set and the smallest id it is linked with over any number of links.

    NULL and wordless texts are linked with nothing.  Rows without an id are linked as all others, but lend no id:
    where no linked row has one, ``component_id`` is NULL.  Rows that repeat an id are told apart by their texts.
    """
    found = JaccardJoin(documents, percent, size).groups()
    given = {c: F.when(F.col(c) != NO_ID, F.col(c)) for c in ("doc", "least")}
    return found.select(given["doc"].alias("doc_id"), F.col("n").alias("n_shingles"), given["least"].alias("component_id"))


def keep_one_of_each(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One document of each group: that with its smallest id, if any has one; columns unchanged.

    Documents without words are in no group and stay, also where they repeat.
    """
    found = JaccardJoin(documents, percent, size).groups()
    rows = cut(found.where("n > 0").select("doc", "mark", "component"))
    # a row without an id counts only where there is no other
    order = F.struct(F.col("doc") == NO_ID, "doc", "mark")
    first = rows.groupBy("component").agg(F.min(order).alias("first"))
    gone = rows.join(first, "component").where("doc <> first.doc OR mark <> first.mark").select("doc", "mark").distinct()
    again = rows.groupBy("doc", "mark").agg(F.count("*").alias("many")).where("many > 1").select("doc", "mark")
    gone, again = (df.select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark")) for df in (cut(gone), cut(again)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = documents.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__mark": F.xxhash64(text)})
    kept = keyed.join(gone, ["__doc", "__mark"], "left_anti")
    single = kept.join(again, ["__doc", "__mark"], "left_anti")
    repeated = kept.join(again, ["__doc", "__mark"], "left_semi").dropDuplicates(["__doc", "__mark"])
    return single.unionByName(repeated).select(*[f"`{c}`" for c in documents.columns])
