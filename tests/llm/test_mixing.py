"""Subset sums against brute force; the mix on small tables with every oddity."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trainlake.llm import mixing

SCHEMA = "doc_id LONG, text STRING, source STRING, size STRING, of INT, row INT, part STRING"


def brute_nearest(lengths, counts, budget):
    sums = {0}
    for length, count in zip(lengths, counts, strict=True):
        sums = {s + k * length for s in sums for k in range(count + 1)}
    return min((abs(s - budget), s) for s in sums if s <= 2 * budget)[1]


@pytest.mark.parametrize("seed", range(60))
def test_nearest_sum(seed):
    r = random.Random(seed)
    lengths = np.array(sorted(r.sample(range(1, 40), r.randint(1, 6)), reverse=r.random() < 0.5))
    counts = np.array([r.randint(0, 3) for _ in lengths])
    budget = r.randint(0, 1 + int((lengths * counts).sum()))
    taken = mixing.nearest_sum(lengths, counts, budget)
    assert (taken >= 0).all() and (taken <= counts).all()
    assert (taken * lengths).sum() == brute_nearest(lengths.tolist(), counts.tolist(), budget)


@pytest.mark.parametrize("window", [8, 1000])
def test_fitted_counts(window):
    r = np.random.default_rng(window)
    for _ in range(40):
        lengths = np.unique(r.integers(1, 900, 60))
        counts = r.integers(1, 30, len(lengths))
        total = int((lengths * counts).sum())
        for budget in (0, 1, total // 3, total - 1, total):
            taken = mixing.fitted_counts(lengths, counts, budget, window)
            assert (taken >= 0).all() and (taken <= counts).all()
            assert abs(int((taken * lengths).sum()) - budget) <= (1 if window > 900 else 900)
    # few and long documents: the nearest there is
    assert mixing.fitted_counts(np.array([70, 1000]), np.array([1, 1]), 500).tolist() == [1, 0]
    assert mixing.fitted_counts(np.array([70, 1000]), np.array([1, 1]), 600).tolist() == [0, 1]


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by the words of the contract: stop at twice the size, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, pool, free = {}, share * sum(sizes.values()), set(order)
    while free:
        level = pool / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        target |= {s: most * sizes[s] if s in over else weight[s] * level for s in free}
        if not over:
            break
        pool -= sum(most * sizes[s] for s in over)
        free -= over
    return target


@pytest.fixture(scope="module")
def documents(spark):
    r, rows = random.Random(7), []
    for i in range(700):
        source = r.choice(["hot"] * 6 + ["b", "", None, "é", "z", "Z"])
        rows.append((i, " ".join("w" * r.randint(1, 5) for _ in range(r.randint(1, 30))) + "\t", source, "x", 1, 2, "p"))
    rows += [(1000, None, "b", None, None, None, None), (1001, "", "none", "x", 1, 2, "p"), (None, "two words", "b", None, 1, 1, "p")]
    rows += [(5, "a b c d", "hot", "x", 1, 2, "p")] * 3 + [(6, "x " * 5000, "long", "x", 1, 2, "p"), (7, "  \x0b\x0c\r\n y", "z", "x", 1, 2, "p")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_mix(spark, documents):
    rows = mixing.mix(documents, bucket=100).collect()
    given = Counter((r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in documents.collect())
    assert Counter((r.doc_id, r.source, r["size"]) for r in rows) == given
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert r.times in (0, 1, 2) and r.taken == r.times * r["size"]
    target = reshared(sizes)
    assert {r.source: r.source_size for r in rows} == sizes
    for r in rows:
        assert r.target == pytest.approx(target[r.source], rel=1e-12)
    for source, t in target.items():
        # documents of one word or two make every sum, but not where there is but one
        assert abs(taken[source] - t) <= (0.5 if source != "long" else 2500), source
    again = mixing.mix(documents.repartition(3), bucket=100).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    other = mixing.mix(documents, seed=1, bucket=100).collect()
    assert Counter(map(tuple, other)) != Counter(map(tuple, rows))


def test_mixed_documents_are_whole(documents):
    taken = mixing.mix(documents).agg(F.sum("taken")).first()[0]
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed.collect()) == taken


def test_sources_that_cannot_be_split(spark):
    rows = [(1, "a b c", "s"), (2, "a b c d e f g", "t"), (3, None, "u")]
    found = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")).collect()}
    # 15 words: s may have 6, t the other 9, u has none; 7 is nearer to 9 than 14
    assert {i: (r.target, r.taken) for i, r in found.items()} == {1: (6.0, 6), 2: (9.0, 7), 3: (0.0, 0)}


def test_empty_mix(spark):
    nothing = spark.createDataFrame([], "doc_id LONG, text STRING, source STRING")
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    silent = spark.createDataFrame([(1, None, None), (2, " ", "s")], nothing.schema)
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mix(silent).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
