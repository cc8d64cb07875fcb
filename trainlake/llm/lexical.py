"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to ``OWNERS`` owners by how many postings they have, the rarest to the first.
Documents are indexed in blocks; items travel in bundles.  A bundle meets the owners one after
another, at each by a cogroup of its block's postings there: the owner adds the integer
contributions of its terms to the bundle's accumulators, which are sparse: (item, document,
score so far).  Frequent terms come last, when few documents are still in play: a document
leaves the bundle once ``k`` others of its block have more than it can still reach with the
greatest contributions of the terms to come.  After the last owner a bundle holds the best of
its block, and one ranking per item selects among the blocks.

A group of a cogroup is one block (about ``BLOCK_DOCS`` documents) and one bundle (at most about
``BUNDLE_ITEMS`` items), however frequent a term is.  Only terms that some item has are indexed; the
filter that says so, and the table that deals terms to owners, are of fixed size.

Documents: NULL or termless text counts nowhere; rows without an id count in all statistics but
can't be ranked; repeated rows are documents of their own.  Items: rows without an id or without
terms have no result; of repeated ids the least text counts.  Terms are compared by 128-bit hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainlake.llm.common import cut, map_arrow, mixed, release, scratch, sliced, slots, text_bytes, texts, word_bounds, word_hashes
from trainlake.llm.sketch import Sketch, counted

OWNERS = 4
#: Documents and postings after which a block is closed; items of a bundle.
BLOCK_DOCS, BLOCK_POSTINGS, BUNDLE_ITEMS = 4096, 2_000_000, 1024
#: Items whose accumulators are held densely at a time.
_CHUNK = 128
#: Size of the filter of the items' terms, and of the table of owners.
LOG_TERMS, LOG_CELLS = 22, 16

_GAPS = np.ones(256, bool)
_GAPS[0x30:0x3A] = _GAPS[0x41:0x5B] = _GAPS[0x61:0x7B] = _GAPS[0x80:] = False

_INDEX = "block LONG, ids BINARY, known BINARY, n BINARY, h1 BINARY, h2 BINARY, df BINARY, at BINARY, tf BINARY"
_BUNDLE = "items BINARY, item BINARY, h1 BINARY, h2 BINARY, weight BINARY, most BINARY, owner BINARY, acc_item BINARY, acc_doc BINARY, acc_score BINARY"
_DTYPES = {
    "ids": "<i8", "known": "?", "n": "<i8", "h1": "<u8", "h2": "<u8", "df": "<u4", "at": "<u4", "tf": "<u4",
    "items": "<i8", "item": "<u4", "weight": "<i8", "most": "<i8", "owner": "<u1", "acc_item": "<u4", "acc_doc": "<u4", "acc_score": "<i8",
}


def _packed(**arrays: np.ndarray) -> dict[str, pa.Array]:
    return {name: pa.array([np.ascontiguousarray(x, _DTYPES[name]).tobytes()], pa.binary()) for name, x in arrays.items()}


def _unpacked(row: pa.Table | pa.RecordBatch, i: int, names: str) -> list[np.ndarray]:
    return [np.frombuffer(row.column(c)[i].as_py(), _DTYPES[c]) for c in names.split()]


def terms(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 128-bit hashes of all terms of a batch's texts, and the first term of each text (one more at the end)."""
    raw, offsets = text_bytes(batch.column("text"))
    starts, ends, first = word_bounds(raw, offsets, _GAPS)
    h1, h2 = (word_hashes(raw, starts, ends, which, lower=True) for which in (0, 1))
    return h1, h2, first


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys start (one more at the end)."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.append(np.flatnonzero(new), n)


def inverted_blocks(documents: DataFrame, wanted: Sketch, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row a block of documents: their ids and term counts, and postings of the wanted terms, by term."""
    shared = documents.sparkSession.sparkContext.broadcast(wanted)

    def read(piece: pa.RecordBatch):
        h1, h2, first = terms(piece)
        n = np.diff(first)
        doc, keep = np.repeat(np.arange(len(n)), n), shared.value.holds(h1)
        ids = piece.column("doc_id")
        return ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), n, doc[keep], h1[keep], h2[keep]

    def closed(held: list, block: int) -> pa.RecordBatch:
        before = np.cumsum([0] + [len(h[0]) for h in held])
        ids, known, n, doc, h1, h2 = (np.concatenate([h[k] + before[i] if k == 3 else h[k] for i, h in enumerate(held)]) for k in range(6))
        order = np.lexsort((doc, h2, h1))
        doc, h1, h2 = doc[order], h1[order], h2[order]
        places = _runs(h1, h2, doc)
        tf, doc, h1, h2 = np.diff(places), doc[places[:-1]], h1[places[:-1]], h2[places[:-1]]
        own = _runs(h1, h2)
        arrays = _packed(ids=ids, known=known, n=n, h1=h1[own[:-1]], h2=h2[own[:-1]], df=np.diff(own), at=doc, tf=tf)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *arrays.values()], ["block", *arrays])

    def build(batches):
        part, number, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for piece in sliced(batch):
                held.append(read(piece))
                if sum(len(h[0]) for h in held) >= block_docs or sum(len(h[3]) for h in held) >= BLOCK_POSTINGS:
                    yield closed(held, part << 32 | number)
                    number, held = number + 1, []
        if held:
            yield closed(held, part << 32 | number)

    return texts(documents).mapInArrow(build, _INDEX)


def _cells(h1: np.ndarray) -> np.ndarray:
    return (mixed(h1, 51) >> np.uint64(64 - LOG_CELLS)).astype(np.int64)


def _lengths(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """The ``m`` of documents with ``n`` terms."""
    return 25 + (75 * n * documents) // words


def _contributions(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class LexicalIndex:
    """The blocks of a corpus, for the terms of the items, with the statistics that ranking needs."""

    def __init__(self, documents: DataFrame, items: DataFrame, owners: int = OWNERS, block_docs: int = BLOCK_DOCS):
        self.spark, self.owners = documents.sparkSession, owners
        rows = items.where(F.col("item_id").isNotNull()).groupBy(F.col("item_id").cast("long").alias("item_id"))
        rows = rows.agg(F.coalesce(F.min(F.col("text").cast("string")), F.lit("")).alias("text"))
        self.asked = cut(map_arrow(rows, _item_terms, "item_id LONG, h1 LONG, h2 LONG, repeats LONG"))
        wanted = counted(self.asked.select("h1"), lambda b: b.column("h1").to_numpy().view(np.uint64), 1, LOG_TERMS)
        self._path = scratch(self.spark)
        self.blocks = cut(inverted_blocks(documents, wanted, block_docs), self._path)

        def sizes(batch: pa.RecordBatch):
            n = [np.frombuffer(x.as_py(), _DTYPES["n"]) for x in batch.column("n")]
            yield pa.RecordBatch.from_arrays([pa.array([int((x > 0).sum()) for x in n], pa.int64()), pa.array([int(x.sum()) for x in n], pa.int64())], ["documents", "words"])

        total = map_arrow(self.blocks.select("n"), sizes, "documents LONG, words LONG").agg(F.sum("documents"), F.sum("words")).first()
        self.documents, self.words = documents_, words = total[0] or 0, total[1] or 0

        def statistics(batch: pa.RecordBatch):
            for i in range(batch.num_rows):
                n, h1, h2, df, at, tf = _unpacked(batch, i, "n h1 h2 df at tf")
                if len(h1):
                    each = _contributions(tf, _lengths(n, documents_, words)[at])
                    most = np.maximum.reduceat(each, np.cumsum(df, dtype=np.int64) - df)
                    made = [h1.view(np.int64), h2.view(np.int64), df.astype(np.int64), most, _cells(h1)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["h1", "h2", "df", "most", "cell"])

        found = map_arrow(self.blocks.select("n", "h1", "h2", "df", "at", "tf"), statistics, "h1 LONG, h2 LONG, df LONG, most LONG, cell LONG")
        self.terms = cut(found.groupBy("h1", "h2").agg(F.sum("df").alias("df"), F.max("most").alias("most"), F.first("cell").alias("cell")))
        self._owner = self.spark.sparkContext.broadcast(self._dealt())

    def _dealt(self) -> np.ndarray:
        """The owner of each cell of term hashes, so that all owners have about as many postings, the rarest terms first."""
        volume = np.zeros(1 << LOG_CELLS)
        for r in self.terms.groupBy("cell").agg(F.sum("df").alias("n")).toArrow().to_batches():  # one row a cell
            volume[r.column(0).to_numpy()] = r.column(1).to_numpy()
        order = np.argsort(volume, kind="stable")
        after = np.cumsum(volume[order])
        owner = np.zeros(len(volume), np.uint8)
        owner[order] = np.minimum((after - volume[order]) * self.owners / max(after[-1], 1), self.owners - 1)
        return owner

    def _bundles(self, bundle_items: int) -> tuple[DataFrame, int]:
        """One row a bundle (``turn``) of items: their terms with weights, greatest contributions and owners; no accumulators yet."""
        n, owner = self.documents, self._owner
        weight = F.floor(1000 * F.log((2.0 * n + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long") * F.col("repeats")
        found = self.asked.join(self.terms, ["h1", "h2"]).select("item_id", "h1", "h2", weight.alias("weight"), "most")
        turns = max(1, -(-self.asked.select("item_id").distinct().count() // bundle_items))

        def pack(rows: pa.Table) -> pa.Table:
            ids = rows.column("item_id").to_numpy()
            items, item = np.unique(ids, return_inverse=True)
            order = np.argsort(item, kind="stable")
            h1, h2, weight, most = (rows.column(c).to_numpy()[order] for c in ("h1", "h2", "weight", "most"))
            h1 = h1.view(np.uint64)
            none = np.empty(0, np.int64)
            made = _packed(items=items, item=item[order], h1=h1, h2=h2.view(np.uint64), weight=weight, most=most, owner=owner.value[_cells(h1)], acc_item=none, acc_doc=none, acc_score=none)
            return pa.table({"turn": rows.column("turn").slice(0, 1), **made})

        turn = F.pmod(F.xxhash64("item_id"), F.lit(turns)).alias("turn")
        return cut(found.select(turn, "*").groupBy("turn").applyInArrow(pack, f"turn LONG, {_BUNDLE}")), turns

    def search(self, k: int = 10, bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
        """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, ties to smaller ids."""
        bundles, turns = self._bundles(bundle_items)
        salts = slots(self.spark)
        # every bundle goes to every block: the copies of one bundle are dealt over the salts
        blocks = self.blocks.select("block", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
        salted = bundles.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), "*")
        travelling = blocks.join(salted, "salt").drop("salt")
        for owner in range(self.owners):
            own = self._postings(owner, turns).groupBy("block", "turn")
            last = owner == self.owners - 1
            schema = "item_id LONG, doc_id LONG, score LONG" if last else f"block LONG, turn LONG, {_BUNDLE}"
            travelling = own.cogroup(travelling.groupBy("block", "turn")).applyInArrow(_stage(owner, k, last), schema)
        best = cut(travelling)
        release(self.blocks, self._path)
        rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
        return best.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")

    def _postings(self, owner: int, turns: int) -> DataFrame:
        """``block, turn`` and the postings of one owner, with the contribution of each."""
        dealt, documents, words = self._owner, self.documents, self.words

        def step(batch: pa.RecordBatch):
            for i in range(batch.num_rows):
                ids, known, n, h1, h2, df, at, tf = _unpacked(batch, i, "ids known n h1 h2 df at tf")
                mine = dealt.value[_cells(h1)] == owner
                of = np.repeat(mine, df)
                each = _contributions(tf[of], _lengths(n, documents, words)[at[of]]) if words else np.empty(0, np.int64)
                made = _packed(ids=ids, known=known, h1=h1[mine], h2=h2[mine], df=df[mine], at=at[of])
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), *made.values(), pa.array([each.astype("<u4").tobytes()], pa.binary())], ["block", *made, "each"])

        own = map_arrow(self.blocks, step, "block LONG, ids BINARY, known BINARY, h1 BINARY, h2 BINARY, df BINARY, at BINARY, each BINARY")
        return own.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("turn"), "*")


def _item_terms(batch: pa.RecordBatch):
    h1, h2, first = terms(batch)
    item = np.repeat(np.arange(batch.num_rows), np.diff(first))
    order = np.lexsort((h2, h1, item))
    item, h1, h2 = item[order], h1[order], h2[order]
    places = _runs(item, h1, h2)
    at, repeats = places[:-1], np.diff(places)
    yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(item[at])), pa.array(h1[at].view(np.int64)), pa.array(h2[at].view(np.int64)), pa.array(repeats)], ["item_id", "h1", "h2", "repeats"])


def _stage(owner: int, k: int, last: bool):
    """What an owner does to a bundle that visits one block: add its terms' contributions, drop what can't be among the ``k`` best."""

    def visit(own: pa.Table, bundle: pa.Table) -> pa.Table:
        names = "items item h1 h2 weight most owner acc_item acc_doc acc_score"
        out: list[tuple] = []
        made = {}
        if own.num_rows and bundle.num_rows:
            ids, known, h1, h2, df, at = _unpacked(own, 0, "ids known h1 h2 df at")
            each = np.frombuffer(own.column("each")[0].as_py(), "<u4").astype(np.int64)
            ends = np.cumsum(df, dtype=np.int64)
            spans = dict(zip(zip(h1.tolist(), h2.tolist(), strict=True), zip((ends - df).tolist(), ends.tolist(), strict=True), strict=True))
            items, item, q1, q2, weight, most, owners, acc_item, acc_doc, acc_score = _unpacked(bundle, 0, names)
            rest = np.zeros(len(items), np.int64)
            later = owners > owner
            np.add.at(rest, item[later], weight[later] * most[later])
            mine = np.flatnonzero(owners == owner)
            for first in range(0, len(items), _CHUNK):
                many = min(_CHUNK, len(items) - first)
                scores = np.zeros((many, len(ids)), np.int64)
                a, b = np.searchsorted(acc_item, (first, first + many))
                scores[acc_item[a:b] - first, acc_doc[a:b]] = acc_score[a:b]
                a, b = np.searchsorted(item[mine], (first, first + many))
                for j in mine[a:b].tolist():
                    if (span := spans.get((int(q1[j]), int(q2[j])))) is not None:
                        s, e = span
                        scores[int(item[j]) - first, at[s:e]] += weight[j] * each[s:e]
                scores[:, ~known] = 0
                for i in range(many):
                    docs = np.flatnonzero(scores[i])
                    reached = scores[i, docs]
                    if len(docs) > k:
                        floor = np.partition(reached, len(docs) - k)[len(docs) - k]
                        keep = reached + rest[first + i] >= floor
                        docs, reached = docs[keep], reached[keep]
                    if last:
                        best = np.lexsort((ids[docs], -reached))[:k]
                        docs, reached = docs[best], reached[best]
                    out.append((np.full(len(docs), first + i), docs, reached))
            columns = [np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out, strict=True) if out else ((), (), ()))]
            if last:
                return pa.table({"item_id": pa.array(items[columns[0]]), "doc_id": pa.array(ids[columns[1]]), "score": pa.array(columns[2])})
            made = _packed(items=items, item=item[later], h1=q1[later], h2=q2[later], weight=weight[later], most=most[later], owner=owners[later], acc_item=columns[0], acc_doc=columns[1], acc_score=columns[2])
            return pa.table({"block": bundle.column("block"), "turn": bundle.column("turn"), **made})
        if last:
            return pa.table({c: pa.array([], pa.int64()) for c in ("item_id", "doc_id", "score")})
        return pa.table({"block": pa.array([], pa.int64()), "turn": pa.array([], pa.int64()), **{c: pa.array([], pa.binary()) for c in names.split()}})

    return visit


def ranked_documents(documents: DataFrame, items: DataFrame, k: int = 10, owners: int = OWNERS, block_docs: int = BLOCK_DOCS, bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
    """The ``k`` highest-scoring documents with a score above 0 for each item: ``item_id, rank, doc_id, score``."""
    return LexicalIndex(documents, items, owners, block_docs).search(k, bundle_items)
