"""Hard negatives against brute force; curve, zones and bounds on their own."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from trainlake.llm import common, negatives


@pytest.mark.parametrize(("axes", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_is_one_path_through_all_cells(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = negatives.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    r = np.random.default_rng(1)
    for _ in range(50):
        x, q = r.normal(size=(30, 9)) * 300, r.normal(size=(7, 9)) * 300
        least, greatest = negatives.bounds(q, x.min(axis=0)[None], x.max(axis=0)[None])
        s = q @ x.T
        assert (s >= least).all() and (s <= greatest).all()
    one = np.floor(r.normal(size=(1, 9)) * 300)
    least, greatest = negatives.bounds(one, one, one)
    assert abs(greatest[0, 0] - (one @ one.T)[0, 0]) < 2 and abs(least[0, 0] - (one @ one.T)[0, 0]) < 2


def brute(rows, step, positives=5, negs=10, window=(30, 90)):
    """``rows``: id → (label, vector of whole numbers)."""
    out = set()
    for a in (i for i in rows if i % step == 0):
        score = {i: int(np.dot(rows[a][1], v)) for i, (_, v) in rows.items() if i != a}
        best = sorted((-s, i) for i, s in score.items() if rows[i][0] == rows[a][0])[:positives]
        for p, i in best:
            inside = sorted((-s, j) for j, s in score.items() if rows[j][0] != rows[a][0] and window[0] * -p <= 100 * s <= window[1] * -p)
            out |= {(a, i, rank, j, -p, -s) for rank, (s, j) in enumerate(inside[:negs], 1)}
    return out


def found(df):
    rows = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def table(spark):
    """Clusters, a hot vector under all labels, ties, and rows that take no part."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 6))
    x = (centres[r.integers(0, 12, 700)] + 0.2 * r.normal(size=(700, 6))).astype(np.float32)
    x[200:420] = x[3]
    x[420:440] = np.round(x[420:440])
    rows = [(i, v.tolist(), int(r.integers(0, 4)), "b", 1) for i, v in enumerate(x)]
    rows += [(700, [0.0] * 6, 1, "b", 1), (710, [0.0] * 6, 2, "b", 1)]
    whole = {i: (label, np.floor(256 * np.array(v, np.float64))) for i, v, label, *_ in rows}
    odd = [(801, None, 1), (802, [1.0] * 6, None), (803, [float("nan")] * 6, 1), (804, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (805, [float("inf")] * 6, 1), (810, [1.0, 2.0], 1), (None, [1.0] * 6, 1), (820, [], 1)]
    schema = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, block STRING, n INT"
    return spark.createDataFrame(rows + [(*o, None, None) for o in odd] + rows[:3], schema).repartition(5), whole


@pytest.mark.parametrize(("block_rows", "bundle_anchors"), [(16, 7), (512, 512)])
def test_hard_negatives(table, block_rows, bundle_anchors):
    df, whole = table
    mined = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, block_rows=block_rows, bundle_anchors=bundle_anchors)
    assert found(mined) == brute(whole, 10)


def test_other_numbers_and_few_rows(spark, table):
    df, whole = table
    small = {i: whole[i] for i in range(420, 440)}
    mined = negatives.hard_negatives(df.where("vec_id BETWEEN 420 AND 439"), F.col("vec_id") % 2 == 0, positives=2, negatives=3, window=(-50, 120), block_rows=4)
    assert found(mined) == brute(small, 2, 2, 3, (-50, 120))
    two = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.3, 0.1], 2)], "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    assert found(negatives.hard_negatives(two, F.col("vec_id") == 0)) == {(0, 1, 1, 2, 256 * 128, 256 * 76)}


def test_zones_choose_the_blocks(spark):
    """On vectors with structure an anchor reads a small part of the blocks."""
    r = np.random.default_rng(9)
    centres = 4 * r.normal(size=(40, 8))
    x = centres[np.repeat(np.arange(40), 50)] + 0.05 * r.normal(size=(2000, 8))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    df = spark.createDataFrame([(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<DOUBLE>, label INT")
    miner = negatives.HardNegatives(negatives.labelled_vectors(df), F.col("vec_id") % 100 == 0, block_rows=25, bundle_anchors=1)
    whole = {i: (i % 3, np.floor(256 * v)) for i, v in enumerate(x)}
    assert found(miner.mined()) == brute(whole, 100)
    pairs = miner.blocks.count() * 20
    assert miner.read["positives"] < 0.2 * pairs and miner.read["negatives"] < 0.8 * pairs


def test_no_table_is_broadcast_for_its_small_file(table, plan, monkeypatch):
    """Copies of bundles and packed columns weigh far more in memory than in files, so no join goes by the files' size."""
    df, whole = table
    plans = []

    def cut(rows):
        plans.append(plan(rows))
        return common.cut(rows)

    monkeypatch.setattr(negatives, "cut", cut)
    mined = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, block_rows=16, bundle_anchors=7)
    plans.append(plan(mined))
    assert sum("SortMergeJoin" in p for p in plans) > 6
    assert not any("Broadcast" in p for p in plans)
    assert found(mined) == brute(whole, 10)


def test_blocks_and_bundles_are_full_however_many_parts(spark, table):
    """The number of asks goes by the rows, not by the square of the session's parts."""
    df, whole = table
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        miner = negatives.HardNegatives(negatives.labelled_vectors(df), F.col("vec_id") % 10 == 0)
        assert miner.blocks.count() <= 2 and miner.bundles.count() == 1
        assert found(miner.mined()) == brute(whole, 10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert miner.read["positives"] + miner.read["negatives"] <= 4


def test_empty_tables(spark):
    schema = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"
    for rows in ([], [(1, [1.0, 2.0], 1)], [(100, [1.0, 2.0], 1)], [(100, None, 1)]):
        assert negatives.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0).count() == 0
