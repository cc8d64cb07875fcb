"""The Jaccard join where ids repeat or are missing, and where lists and classes are dealt out in parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trainlake.llm import jaccard


def words(seed, n):
    r = random.Random(seed)
    return [f"{r.choice('abcdefgh')}{r.randint(0, 99)}" for _ in range(n)]


def close(text, k=3):
    return " ".join([*text.split()[:-k], *(f"x{i}" for i in range(k))])


A, B, C, D, E = (" ".join(words(s, 80)) for s in range(5))
SCHEMA = "doc_id LONG, text STRING, node STRING, part INT"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)


def groups(df):
    return sorted(((r.doc_id, r.component_id) for r in jaccard.linked_groups(df).collect()), key=str)


def kept(df):
    out = jaccard.keep_one_of_each(df)
    assert out.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_one_id_with_two_texts_and_copies_without_id(spark):
    df = table(spark, [(1, A), (2, A), (2, B), (3, close(B)), (None, A), (None, A)])
    assert groups(df) == sorted([(1, 1), (2, 1), (2, 2), (3, 2), (None, 1), (None, 1)], key=str)
    assert kept(df) == sorted([(1, A), (2, B)], key=str)


def test_ids_that_name_two_classes_and_groups_without_ids(spark):
    rows = [(5, D), (5, E), (6, close(E)), (7, close(D)), (None, C), (None, close(C)), (None, C), (8, None), (8, None), (None, ""), (9, A), (9, A), (9, A)]
    df = table(spark, rows)
    assert groups(df) == sorted([(5, 5), (5, 5), (6, 5), (7, 5), (None, None), (None, None), (None, None), (8, 8), (8, 8), (None, None), (9, 9), (9, 9), (9, 9)], key=str)
    found = kept(df)
    assert [t for i, t in found if i == 5 and t] and sorted(t for i, t in found if i == 5) == sorted([D, E])
    assert [i for i, _ in found].count(9) == 1 and [i for i, _ in found].count(8) == 2
    assert sum(t in (C, close(C)) for _, t in found) == 1 and len(found) == 2 + 1 + 1 + 2 + 1


def brute(texts):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    group = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    return dict(enumerate(group))


def test_sketches_never_differ_too_much():
    r = np.random.default_rng(4)
    for _ in range(300):
        a, b = (np.unique(r.integers(0, 2**63, r.integers(1, 200)).astype(np.uint64)) for _ in "ab")
        both = np.unique(r.integers(0, 2**63, r.integers(0, 300)).astype(np.uint64))
        x, y = (int.from_bytes(jaccard._sketch(np.union1d(s, both)), "little") for s in (a, b))
        assert (x ^ y).bit_count() <= len(np.setxor1d(np.union1d(a, both), np.union1d(b, both)))


@pytest.mark.parametrize(("log_hot", "part", "back", "long"), [(1, 4, 3, 0), (3, 16, 1, 8), (16, 4096, 3, 32)])
def test_hot_lists_and_classes_in_parts(spark, monkeypatch, log_hot, part, back, long):
    """A group of near copies, several groups that share a passage, many exact copies, small lists beside hot ones."""
    monkeypatch.setattr(jaccard, "LOG_HOT", log_hot)
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "BACK", back)
    monkeypatch.setattr(jaccard, "LONG_LIST", long)
    r, passage, texts = random.Random(1), words(50, 30), []
    for i in range(60):
        w = words(60, 100)
        w[r.randrange(100)] = f"y{i}"
        texts.append(" ".join(w))
    for i in range(40):
        texts.append(" ".join(words(100 + i, 10) + passage + words(200 + i, 8)))
        texts.append(" ".join(words(100 + i, 10) + passage + words(200 + i, 7) + [f"z{i}"]))
    star = words(70, 60)  # copies that differ too much from one another, though not from the first
    texts += [" ".join([*star[: 5 * (i % 11)], f"v{i}", *star[5 * (i % 11) + 1 :]]) for i in range(44)] + [" ".join(star)]
    texts += [A] * 30 + [" ".join(words(300 + i // 2, 40) + [f"u{i}"]) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(4)
    assert {r.doc_id: r.component_id for r in jaccard.linked_groups(df).collect()} == brute(texts)


def test_tables_are_given_back(spark, monkeypatch):
    """What the join has written is empty again but for the classes, the links and the components."""
    written = []
    real = jaccard.scratch

    def scratch(session):
        written.append(real(session))
        return written[-1]

    monkeypatch.setattr(jaccard, "scratch", scratch)
    df = table(spark, [(i, close(A, 1 + i % 3)) for i in range(20)] + [(50, B), (51, close(B))])
    assert jaccard.linked_groups(df).select(F.count_distinct("component_id")).first()[0] == 2
    assert len(written) > 8 and all(spark.read.parquet(p).count() == 0 for p in written)


def test_stragglers_are_not_compared_with_a_whole_group(spark, monkeypatch):
    """Copies of one text that differ about as much as they may: most are linked at once, the others to many of these."""
    compared = []
    real = jaccard.JaccardJoin._verified

    def verified(self, pairs, marks):
        compared.append(pairs.count())
        return real(self, pairs, marks)

    monkeypatch.setattr(jaccard.JaccardJoin, "_verified", verified)
    r, base, texts = random.Random(3), words(90, 300), []
    for i in range(400):
        w = list(base)
        for k in r.sample(range(300), r.choice([3, 4, 5, 6])):
            w[k] = f"q{i}x{k}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(4)
    assert {r.doc_id: r.component_id for r in jaccard.linked_groups(df).collect()} == brute(texts)
    assert sum(compared[1:]) < 2 * len(texts)


def test_sketches_are_compared_before_sets_are_sent():
    r = np.random.default_rng(5)
    a, b = (np.unique(r.integers(0, 2**63, 300).astype(np.uint64)) for _ in "ab")
    close = np.union1d(a[20:], b[:20])
    x, y, z = (jaccard._marked([], s) for s in (a, b, close))
    assert jaccard._near(x, z, 75) and not jaccard._near(x, y, 75)
    assert int.from_bytes(x[jaccard.HEAD - 4 : jaccard.HEAD], "little") == len(a) and len(x) == jaccard.HEAD
