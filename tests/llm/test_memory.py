"""Steps on whole texts and on the driver take memory by pieces, not by all there is."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from trainlake.llm import sketch, toxicity
from trainlake.llm.common import PIECE_BYTES, SLICE_BYTES, cut, map_arrow, mixed, release, scratch, text_bytes, word_bounds, word_hashes
from trainlake.llm.jaccard import JaccardJoin


def _peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _alone(word, which, lower):
    raw = np.frombuffer(word, np.uint8)
    return word_hashes(raw, np.array([0]), np.array([len(raw)]), which, lower)[0]


def test_words_are_hashed_by_pieces():
    short = [f"Word{n % 977}É" for n in range(300_000)]
    text = " ".join([*short, "l" * (2 * PIECE_BYTES), "end"])
    raw, offsets = text_bytes(pa.array(["", text, "  ", "A b"]))
    starts, ends, _ = word_bounds(raw, offsets)
    found, peak = _peak(lambda: word_hashes(raw, starts, ends, 1, lower=True))
    assert len(raw) > 2_000_000 and peak < 12 * len(raw)
    words = [raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    for n in [*range(0, 2000), *range(299_000, len(words))]:
        assert found[n] == _alone(words[n], 1, True)
    same = dict(zip(words, found.tolist(), strict=True))
    assert all(same[w] == h for w, h in zip(words, found.tolist(), strict=True))
    assert len(word_hashes(raw[:0], starts[:0], ends[:0])) == 0


def test_the_frequency_table_is_summed_up_in_little_room(spark):
    tokens = mixed(np.arange(2000, dtype=np.uint64), 5)
    rows = spark.createDataFrame([(int(t),) for t in tokens.view(np.int64)] + [(int(tokens.view(np.int64)[0]),)] * 500, "token LONG").repartition(3)
    classes, peak = _peak(lambda: sketch.frequency_classes(rows, lambda b: b.column("token").to_numpy().view(np.uint64)))
    assert sketch.class_of(tokens[:1], classes)[0] == 1 + int(np.log2(499 / 7))
    assert not sketch.class_of(tokens[1:], classes).any()
    # the table itself, a copy for its median, the classes, and not much more
    assert peak < 12 << sketch.LOG_CELLS


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    spark.conf.unset(_BATCH)
    yield
    spark.conf.unset(_BATCH)


def _rows(spark, n=40, letters=500_000):
    return spark.range(n, numPartitions=1).selectExpr("id AS doc_id", f"repeat(chr(int(97 + id % 26)), if(id = 7, {3 * SLICE_BYTES}, {letters})) AS text")


def test_batches_sent_to_workers_are_bounded_by_bytes(spark, unset):
    def step(batch):
        # a slice still has the text of the whole batch behind it
        text = batch.column("text")
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in text.to_pylist()]), pa.array([text.buffers()[2].size] * batch.num_rows)], ["id", "n", "sent"])

    found = {r["id"]: (r["n"], r["sent"]) for r in map_arrow(_rows(spark), step, "id LONG, n LONG, sent LONG").collect()}
    # every row whole, the longest one too, and nothing but that one over the size
    assert {i: n for i, (n, _) in found.items()} == {i: 3 * SLICE_BYTES if i == 7 else 500_000 for i in range(40)}
    assert max(sent for i, (_, sent) in found.items() if i > 7) <= SLICE_BYTES + 500_000
    assert max(sent for _, sent in found.values()) <= 4 * SLICE_BYTES + 500_000


def test_scores_are_made_of_small_batches(spark, unset):
    most = 4 * SLICE_BYTES + 500_000

    def text_of(batch):
        assert batch.column("text").buffers()[2].size <= most
        return batch.column("text")

    model = toxicity.Model(toxicity.Lexicon({}), np.array([-35.0, 0, 0, 0, 0, 0]))
    assert toxicity._scored(_rows(spark), model, text_of).select("doc_id", "score").count() == 40


def test_a_session_keeps_its_own_batch_size(spark, unset):
    spark.conf.set(_BATCH, "1234567")
    map_arrow(_rows(spark), lambda batch: iter([batch]), "doc_id LONG, text STRING")
    assert spark.conf.get(_BATCH) == "1234567"


def test_few_pairs_take_one_worker_a_task(spark, plan):
    """The filter of a side and the comparison after the join are in stages of their own, however few the pairs."""
    join = JaccardJoin(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id LONG, text STRING"))
    pairs = cut(spark.createDataFrame([(1, 2)], "a LONG, b LONG"))
    own = cut(spark.createDataFrame([(n, bytes([n])) for n in range(5)], "node LONG, marks BINARY"))
    joined = join._joined(pairs, own, "marks")
    assert "BroadcastHashJoin" not in plan(joined)
    assert [tuple(r) for r in joined.collect()] == [(b"\1", b"\2", 1, 2)]


def test_a_table_is_emptied_without_rows_from_the_driver(spark, monkeypatch):
    path = scratch(spark)
    table = cut(spark.range(5).selectExpr("id", "array(id) AS ids", "'x' AS `a.b`"), path)
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    release(table, path)
    left = spark.read.parquet(path)
    assert left.count() == 0 and left.dtypes == table.dtypes
